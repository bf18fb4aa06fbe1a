"""Stream ETL as a DataFrame function (C1, B24-B25, B1-B8, D1, D2, B14-B17,
D6, B21-B22, C3).

``etl(raw, rules, hot_ips)`` turns raw ``#CS#`` lines (one ``value``
column) into the 18-field processed log.  It is narrow except for the
hot-IP membership join, so in a stream it runs per micro-batch inside
``foreachBatch`` with the rule snapshot of that batch (A7 / G6).

Parse rules are small configuration: the index of the *last* matching rule
is computed per row with one ``when`` chain, and each rule contributes one
extraction branch whose JsonPath / XPath strings are literals (Spark's
``xpath*`` functions need a foldable path).
"""

from __future__ import annotations

from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masking import mask_id_card, mask_phone, md5_upper
from ..functions.xml import page_values
from ..functions.parsing import (COOKIE_SESSION_KEY, COOKIE_USER_KEY, cookie_entries, field,
                                 form_param, form_params, json_field, json_texts_of, last_value, param, read_together,
                                 request_url, split_raw, travel_id_text, url_params)
from ..functions.tags import (BEHAVIOR_TYPE_IDS, FLIGHT_TYPE_IDS, TRAVEL_TYPE_IDS, classify_request,
                              enum_id, hot_ip_flag, matches_any, travel_type)
from ..schemas import BOOK_FIELDS, BOOK_LISTS, PROCESSED_FIELDS, QUERY_FIELDS, RAW_SEP

QUERY_KEYS = ["depCity", "arrCity", "flightDate", "adultNum", "childNum", "infantNum", "country",
              "travelType"]


@dataclass
class ParseRule:
    """One row of the parse-rule table (M7)."""
    rule_id: str
    method: str
    behavior_type: int
    match: str
    flight_type: int = -1
    normal_get: bool = False
    normal_form: bool = False
    application_json: bool = False
    text_xml: bool = False
    is_json: bool = False
    is_xml: bool = False
    form_field: str = ""
    query: dict = dc_field(default_factory=dict)
    book: dict = dc_field(default_factory=dict)


@dataclass
class EtlRules:
    """Rule snapshot (M12) used by one ETL run / micro-batch."""
    filter_rules: list = dc_field(default_factory=list)
    nation_query: list = dc_field(default_factory=list)
    internation_query: list = dc_field(default_factory=list)
    nation_book: list = dc_field(default_factory=list)
    internation_book: list = dc_field(default_factory=list)
    query_rules: list = dc_field(default_factory=list)
    book_rules: list = dc_field(default_factory=list)


def last_match(rules: list[ParseRule], method: Column, behavior_id: Column, url: Column) -> Column:
    """Index of the last rule whose method (any case), behaviour and URL match."""
    idx = None
    for i in reversed(range(len(rules))):
        r = rules[i]
        cond = ((F.upper(method) == r.method.upper()) & (behavior_id == r.behavior_type)
                & matches_any(url, [r.match]))
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    return idx if idx is not None else F.lit(None).cast("int")


def _blank(s: str | None) -> bool:
    return s is None or s.strip() == ""


def _query_from_map(m: Column, r: ParseRule) -> dict:
    """Fields from a parameter map; empty map leaves the record empty."""
    keys = r.query
    nonempty = F.size(m) > 0
    out = {k: F.when(nonempty, param(m, keys.get(k, ""), "")).otherwise(F.lit(""))
           for k in QUERY_KEYS if k != "travelType"}
    out["isEmpty"] = ~nonempty
    return out


def query_params(m: Column, r: ParseRule) -> Column:
    """Parameter map -> the fields that a rule names, with the travel
    type as a number.

    Without a parameter for it, with a blank or with text that is no number
    the travel type is -1.  In a whole record (:func:`query_request`) the
    referrer's travel type takes its place (P20).
    """
    key = r.query.get("travelType", "")
    travel = F.lit(-1) if _blank(key) else travel_id_text(param(m, key, ""))
    vals = _query_from_map(m, r)
    return F.struct(vals["isEmpty"].alias("isEmpty"), travel.alias("travelType"),
                    *[vals[k].alias(k) for k in QUERY_KEYS if k != "travelType"])


def _query_from_json(js: Column, r: ParseRule) -> dict:
    """JsonPath extraction; blank JSON leaves the record empty."""
    ok = F.coalesce(F.trim(js), F.lit("")) != ""
    found = _descents(js, r.query)
    out = {k: F.when(ok, _json_value(js, r.query.get(k, ""), found)).otherwise(F.lit(""))
           for k in QUERY_KEYS if k != "travelType"}
    out["isEmpty"] = ~ok
    return out


def _query_from_xml(page: Column, r: ParseRule) -> dict:
    """XPath per rule field (read by :func:`query_source`), blank -> ``""``."""
    out = {}
    for k in QUERY_KEYS:
        if k == "travelType":
            continue
        out[k] = (F.lit("") if _blank(r.query.get(k, ""))
                  else F.coalesce(F.nullif(F.trim(page[k]), F.lit("")), F.lit("")))
    out["isEmpty"] = F.lit(False)
    return out


def query_source(r: ParseRule, url: Column, body: Column, content_type: Column) -> Column | None:
    """Per-rule input of the query parse: a parameter map, a JSON text or
    the values of an XML page (computed once per row, then read by every field)."""
    m = r.method.upper()
    if m == "GET" and r.normal_get:
        return url_params(url)
    if m == "POST" and r.normal_form:
        return form_params(body)
    if m == "POST" and r.is_json and not _blank(r.form_field):
        return form_param(body, r.form_field)
    if m == "POST" and r.text_xml and r.is_xml:
        ok = (F.lower(content_type) == "text/xml") & (body != "")
        return page_values(F.when(ok, body), firsts={k: r.query[k] for k in QUERY_KEYS
                                                     if k != "travelType" and not _blank(r.query.get(k, ""))})
    return None


def query_request(rules: list[ParseRule], idx: Column, sources: list[Column | None],
                  flight_id: Column, travel_id: Column) -> Column:
    """Query-request record of a row (M4).

    ``idx`` is the last matching rule (:func:`last_match`), ``sources`` the
    per-rule inputs (:func:`query_source`), both already projected.
    """
    empty = {k: F.lit("") for k in QUERY_KEYS if k != "travelType"}
    empty["isEmpty"] = F.lit(True)
    acc = dict(empty)
    for i, (r, src) in enumerate(zip(rules, sources)):
        if src is None:
            continue
        m = r.method.upper()
        if (m == "GET" and r.normal_get) or (m == "POST" and r.normal_form):
            vals = _query_from_map(src, r)
        elif m == "POST" and r.is_json and not _blank(r.form_field):
            vals = _query_from_json(src, r)
        else:
            x = _query_from_xml(src, r)
            vals = {k: F.when(src.isNotNull(), x[k]).otherwise(empty[k]) for k in empty}
        for k in acc:
            acc[k] = F.when(idx == i, vals[k]).otherwise(acc[k])
    # The behaviour's flight type and the referrer's travel type win (P20).
    return F.struct(
        acc["isEmpty"].alias("isEmpty"), flight_id.alias("flightType"), travel_id.alias("travelType"),
        *[acc.get(k, F.lit("")).alias(k) for k in QUERY_FIELDS])


def _descents(js: Column, paths: dict[str, str]) -> dict[str, Column]:
    """Matches of the paths with a recursive descent, and of those read along with them."""
    return json_texts_of(js, read_together(paths.values()))


def _json_value(js: Column, path: str, found: dict[str, Column]) -> Column:
    """One field; a path among ``found`` gives its first match."""
    if path in found:
        return F.coalesce(F.get(found[path], F.lit(0)), F.lit(""))
    return json_field(js, path or "$.__none__")


def _json_list(js: Column, path: str, found: dict[str, Column] | None = None) -> Column:
    if _blank(path):
        return F.array().cast("array<string>")
    if ".." in path:
        return (found or _descents(js, {"": path}))[path]
    # A wildcard that matches once gives the bare value, not a list.
    hit = F.get(found[path], F.lit(0)) if path in (found or {}) else F.get_json_object(js, path)
    listed = F.when(hit.startswith("["), hit).otherwise(F.concat(F.lit("["), hit, F.lit("]")))
    return F.coalesce(F.from_json(listed, "array<string>"), F.array().cast("array<string>"))


def _json_one(js: Column, path: str, found: dict[str, Column]) -> Column:
    """A scalar path as a list of at most one element."""
    if _blank(path):
        return F.array().cast("array<string>")
    v = F.get(found[path], F.lit(0)) if path in found else F.get_json_object(js, path)
    return F.filter(F.array(v), lambda x: x.isNotNull())


def _book_from_json(js: Column, r: ParseRule) -> dict:
    """Booking JSON (cleaned by :func:`book_source`) -> lists;
    passenger name = first + last name."""
    p = r.book
    found = _descents(js, p)
    many = lambda k: _json_list(js, p.get(k, ""), found)
    one = lambda k: _json_one(js, p.get(k, ""), found)
    value = lambda k: _json_value(js, p.get(k) or "", found)
    first, last = many("psgFirName"), many("psgName")
    # One name per first name; Java string concatenation prints "null".
    names = F.slice(F.zip_with(first, last, lambda a, b: F.concat(F.coalesce(a, F.lit("null")), F.coalesce(b, F.lit("null")))),
                    F.lit(1), F.size(first))
    return {
        "bookUserId": value("bookUserId"),
        "psgName": names,
        "idType": many("idType"),
        "idCard": many("idCard"),
        "contractName": value("contractName"),
        "contractPhone": value("contractPhone"),
        "depCity": one("depCity"),
        "arrCity": one("arrCity"),
        "flightDate": one("flightDate"),
        "flightNo": one("flightNo"),
        "cabin": one("cabin"),
    }


# Fields of a booking XML that are lists, and those of one value.
XML_LISTS = ["psgName", "psgType", "idType", "idCard", "depCity", "arrCity", "flightDate", "flightNo", "cabin"]
XML_FIRSTS = ["bookUserId", "bookUnUserId", "contractName", "contractPhone"]


def _book_from_xml(page: Column, r: ParseRule) -> dict:
    """Values of a booking XML (read by :func:`book_source`) -> lists;
    contact name before ``|``, contact phone before ``/``."""
    out = {k: F.array().cast("array<string>") if _blank(r.book.get(k, "")) else page[k] for k in XML_LISTS}
    out |= {k: F.lit("") if _blank(r.book.get(k, "")) else F.coalesce(page[k], F.lit("")) for k in XML_FIRSTS}
    out["contractName"] = F.substring_index(out["contractName"], "|", 1)
    out["contractPhone"] = F.substring_index(out["contractPhone"], "/", 1)
    return out


def book_source(r: ParseRule, body: Column, content_type: Column) -> Column | None:
    """Per-rule input of the booking parse (JSON text or values of an XML page, else NULL)."""
    ct = F.lower(content_type)
    if r.text_xml and r.is_xml:
        named = lambda keys: {k: r.book[k] for k in keys if not _blank(r.book.get(k, ""))}
        return page_values(F.when((ct == "text/xml") & (body != ""), body), named(XML_LISTS), named(XML_FIRSTS))
    if r.application_json and r.is_json and not r.normal_form:
        return F.when((ct == "application/json") & (body != ""), F.trim(F.replace(body, F.lit("\\x22"), F.lit(""))))
    if r.is_json and not r.normal_form and not r.application_json and not _blank(r.form_field):
        js = form_param(body, r.form_field)
        js = F.when(js.startswith("[") & js.endswith("]"),
                    F.substring(js, F.lit(2), F.length(js) - 2)).otherwise(js)
        return F.when(F.trim(js) != "", F.trim(F.replace(js, F.lit("\\x22"), F.lit(""))))
    return None


def book_request(rules: list[ParseRule], idx: Column, sources: list[Column | None],
                 travel_id: Column) -> Column:
    """Booking record (M5); contact phone and id cards hashed."""
    empty_list = F.array().cast("array<string>")
    empty = {k: empty_list if k in BOOK_LISTS else F.lit("") for k in BOOK_FIELDS}
    acc = dict(empty)
    flight = F.lit(-1)
    travel = F.lit(-1)
    # A row has one rule, so JSON rules with the same paths are read as one.
    alike = {}
    for i, (r, src) in enumerate(zip(rules, sources)):
        if src is not None:
            paths = i if r.text_xml and r.is_xml else tuple(sorted((k, p) for k, p in r.book.items() if p))
            alike.setdefault(paths, []).append((r, F.when(idx == i, src)))
    for group in alike.values():
        r, src = group[0][0], F.coalesce(*[s for _, s in group])
        vals = _book_from_xml(src, r) if (r.text_xml and r.is_xml) else _book_from_json(src, r)
        for k in vals:
            acc[k] = F.when(src.isNotNull(), vals[k]).otherwise(acc[k])
    for i, r in enumerate(rules):
        if r.flight_type in (0, 1):
            flight = F.when(idx == i, F.lit(r.flight_type)).otherwise(flight)
            travel = F.when(idx == i, travel_id).otherwise(travel)
    acc["idCard"] = F.transform(acc["idCard"], md5_upper)
    acc["contractPhone"] = md5_upper(acc["contractPhone"])
    return F.struct(flight.alias("flightType"), travel.alias("travelType"), *[acc[k].alias(k) for k in BOOK_FIELDS])


def filter_lines(raw: DataFrame, filter_rules: list[str], drop: bool = True) -> DataFrame:
    """Drop lines whose request line fully matches a filter rule,
    or (``drop=False``) keep every line and add the ``matched`` flag."""
    line = field(F.split(F.col("value"), RAW_SEP, -1), 1)
    hit = matches_any(line, filter_rules)
    if drop:
        return raw.filter(~hit)
    return raw.withColumn("matched", hit)


def etl(raw: DataFrame, rules: EtlRules, hot_ips: DataFrame | None = None,
        hot_col: str = "ip_name") -> DataFrame:
    """Raw lines -> processed log (M10), the full ETL of one batch.

    Written as staged projections: every intermediate that later steps
    read several times (masked text, cookie entries, rule index, parse
    inputs) is its own column, so it is computed once per row.
    """
    kept = filter_lines(raw, rules.filter_rules)                                      # C1
    masked = (kept.select(mask_phone("value").alias("value"))                          # B24
                  .select(mask_id_card("value").alias("value")))                       # B25
    f = masked.select(split_raw("value").alias("f")).select("f.*")                    # B1
    # D6 before anything is parsed: the join moves the plain fields only.
    if hot_ips is None:
        f = f.withColumn("__is_hot", F.lit(False))
    else:
        f = hot_ip_flag(f, "remoteAddr", hot_ips, hot_col, "__is_hot")
    s = f.select(
        "__is_hot", "requestMethod", request_url(F.col("requestLine")).alias("request"),           # B2
        "contentType", "requestBody", "httpReferrer", "remoteAddr", "httpUserAgent",
        "timeIso8601", "serverAddr", cookie_entries(F.col("cookie")).alias("__ck"))     # B3-B6
    s = s.select(
        "*",
        last_value(F.col("__ck"), COOKIE_SESSION_KEY).alias("JSESSIONID"),
        last_value(F.col("__ck"), COOKIE_USER_KEY).alias("USERID"),
        classify_request(F.col("request"), rules.nation_query, rules.internation_query,  # D1
                         rules.nation_book, rules.internation_book).alias("cls"),
        travel_type(F.col("httpReferrer")).alias("travelType"))                          # D2
    s = s.select(
        "*",
        enum_id(F.col("cls.flightType"), FLIGHT_TYPE_IDS).alias("__flight_id"),
        enum_id(F.col("cls.behaviorType"), BEHAVIOR_TYPE_IDS).alias("__behavior_id"),
        enum_id(F.col("travelType"), TRAVEL_TYPE_IDS).alias("__travel_id"))
    method, ctype, url, body = (F.col("requestMethod"), F.col("contentType"), F.col("request"),
                                F.col("requestBody"))
    beh_id = F.col("__behavior_id")
    # A rule's input is built only on the lines that rule parses.
    qsrc = [query_source(r, url, F.when(F.col("__qi") == i, body), ctype) for i, r in enumerate(rules.query_rules)]
    bsrc = [book_source(r, F.when(F.col("__bi") == i, body), ctype) for i, r in enumerate(rules.book_rules)]
    s = s.select(
        "*",
        last_match(rules.query_rules, method, beh_id, url).alias("__qi"),
        last_match(rules.book_rules, method, beh_id, url).alias("__bi"))
    s = s.select(
        "*",
        *[F.when(F.col("__qi") == i, c).alias(f"__qs{i}") for i, c in enumerate(qsrc) if c is not None],
        *[F.when(F.col("__bi") == i, c).alias(f"__bs{i}") for i, c in enumerate(bsrc) if c is not None])
    qcols = [F.col(f"__qs{i}") if c is not None else None for i, c in enumerate(qsrc)]
    bcols = [F.col(f"__bs{i}") if c is not None else None for i, c in enumerate(bsrc)]
    parsed = s.select(
        "*",
        query_request(rules.query_rules, F.col("__qi"), qcols, F.col("__flight_id"),   # B14
                      F.col("__travel_id")).alias("q"),
        book_request(rules.book_rules, F.col("__bi"), bcols, F.col("__travel_id")).alias("b"))  # B15
    beh = F.col("cls.behaviorType")
    # Core parameters from the query record, or the booking lists joined.
    core = {k: F.when(beh == "Query", F.col(f"q.{qk}"))
                .when(beh == "Book", F.array_join(F.col(f"b.{qk}"), ""))
                .otherwise(F.lit(""))
            for k, qk in (("flightDate", "flightDate"), ("depcity", "depCity"), ("arrcity", "arrCity"))}
    cols = {
        "requestMethod": F.col("requestMethod"), "request": F.col("request"),
        "remoteAddr": F.col("remoteAddr"), "httpUserAgent": F.col("httpUserAgent"),
        "timeIso8601": F.col("timeIso8601"), "serverAddr": F.col("serverAddr"),
        "highFrqIPGroup": F.when(F.col("__is_hot"), "true").otherwise("false"),
        "flightType": F.col("cls.flightType"), "behaviorType": beh, "travelType": F.col("travelType"),
        "flightDate": core["flightDate"], "depcity": core["depcity"], "arrcity": core["arrcity"],
        "JSESSIONID": F.col("JSESSIONID"), "USERID": F.col("USERID"),
        "queryRequestDataStr": F.to_json(F.col("q")), "bookRequestDataStr": F.to_json(F.col("b")),
        "httpReferrer": F.col("httpReferrer"),
    }
    # B22 replaces empty text by NULL on the wire; keep that in the columns.
    return parsed.select(*[F.when(cols[n] == "", F.lit("NULL")).otherwise(cols[n]).alias(n)
                           for n in PROCESSED_FIELDS])


def split_by_behavior(processed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Query stream and booking stream; ``Other`` goes to neither."""
    return (processed.filter(F.col("behaviorType") == "Query"),
            processed.filter(F.col("behaviorType") == "Book"))
