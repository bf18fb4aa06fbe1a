"""skywarden: traffic-risk analytics for a ticket-booking site, on Spark.

Raw access-log lines are filtered, masked, split, classified and parsed
(``operators.etl``); per-IP window metrics are scored against rule flows
to build a blacklist (``operators.windows`` + ``operators.scoring``);
logs joined with the blacklist feed the conversion / flow indicators
(``operators.indicators``); monitoring roll-ups and dashboard reports live
in ``operators.monitor`` and ``operators.reports``.  Every operator is a
plain ``DataFrame -> DataFrame`` (or ``Column -> Column``) function, so
the same code runs in batch and inside Structured Streaming.
"""

__version__ = "0.1.0"
