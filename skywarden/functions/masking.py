"""Personal-data masking (B24-B26) as native higher-order expressions.

A number is replaced by its upper-case MD5 when the first place it occurs
in the text is bounded by non-digits; once accepted, every occurrence is
replaced (P2).  Start of text counts as a non-digit boundary.  The phone
pass runs first and the id-card pass sees its output (P26).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mainland mobile numbers and id-card numbers.
PHONE_PATTERN = r"((13[0-9])|(14[5|7])|(15([0-3]|[5-9]))|(17[0-9])|(18[0,5-9]))\d{8}"
ID_CARD_PATTERN = r"(\d{18})|(\d{17}(\d|X|x))|(\d{15})"


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def md5_upper(col) -> Column:
    """Upper-case hex MD5 of the UTF-8 text (ASCII-identical, P3)."""
    return F.upper(F.md5(_c(col)))


def _is_digit(ch: Column) -> Column:
    """``ch`` is one ASCII digit (``ch`` is a one-character string or '')."""
    return (F.length(ch) == 1) & (ch >= F.lit("0")) & (ch <= F.lit("9"))


def _mask(text: Column, pattern: str, digits: int) -> Column:
    """Replace accepted matches of ``pattern`` in ``text`` by their MD5.

    Every match holds a run of ``digits`` digits; a text without one, found
    by a plain scan, is passed on as it is.

    The boundary test only reads the original text, so accepted matches
    are chosen first (one ``position`` per match) and then replaced in
    order.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    cands = F.transform(found, lambda m: F.struct(m.alias("m"), F.position(m, text).alias("p")))

    def bounded(x: Column) -> Column:
        before = F.when(x["p"] > 1, F.substring(text, x["p"] - 1, 1)).otherwise(F.lit(""))
        after = F.substring(text, x["p"] + F.length(x["m"]), 1)
        return ~_is_digit(before) & ~_is_digit(after)

    accepted = F.filter(cands, bounded)
    masked = F.aggregate(accepted, text, lambda acc, x: F.replace(acc, x["m"], md5_upper(x["m"])))
    return F.when(text.rlike(f"[0-9]{{{digits}}}"), masked).otherwise(text)


def mask_phone(col) -> Column:
    """Hash 11-digit mobile numbers bounded by non-digits."""
    t = _c(col)
    return F.when(t.isNull(), t).otherwise(_mask(t, PHONE_PATTERN, 11))


def mask_id_card(col) -> Column:
    """Hash 18 / 17+X / 15-digit id-card numbers bounded by non-digits."""
    t = _c(col)
    return F.when(t.isNull(), t).otherwise(_mask(t, ID_CARD_PATTERN, 15))


def mask_all(col) -> Column:
    """B24 then B25, the order the ETL applies them.

    For a DataFrame prefer two projections (phone, then id card) so the
    phone-masked text is a column: nested, it is re-evaluated per match.
    """
    return mask_id_card(mask_phone(col))


def mask_columns(df, col: str, out: str | None = None):
    """B24 then B25 on ``df[col]`` as two staged projections."""
    out = out or col
    others = [c for c in df.columns if c != col]
    return (df.select(*others, mask_phone(col).alias("__masked"))
              .select(*others, mask_id_card("__masked").alias(out)))


def _sql_mask(text: str, pattern: str) -> str:
    return (f"list_reduce(regexp_extract_all({text}, '{pattern}'), "
            f"lambda acc, m: CASE WHEN (strpos({text}, m) <= 1 OR NOT regexp_full_match("
            f"substr({text}, strpos({text}, m) - 1, 1), '[0-9]')) AND NOT regexp_full_match("
            f"substr({text}, strpos({text}, m) + length(m), 1), '[0-9]') "
            f"THEN replace(acc, m, upper(md5(m))) ELSE acc END, {text})")


def sql_mask_phone(text: str) -> str:
    """DuckDB twin of :func:`mask_phone` over SQL expression ``text``."""
    return _sql_mask(text, PHONE_PATTERN)


def sql_mask_id_card(text: str) -> str:
    return _sql_mask(text, ID_CARD_PATTERN)
