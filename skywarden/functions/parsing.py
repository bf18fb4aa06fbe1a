"""Log-line parsing expressions.

All native Spark expressions (split / higher-order functions / JSON), so
they stay inside whole-stage codegen and work unchanged on streams.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (BEHAVIOR_TYPE_IDS, BOOK_RECORD, FLIGHT_TYPE_IDS, PROCESSED_FIELDS, QUERY_RECORD, RAW_FIELDS,
                       RAW_SEP, TRAVEL_TYPE_IDS)
from .members import member_reader

# Cookie keys picked from the cookie map.
COOKIE_SESSION_KEY = "JSESSIONID"
COOKIE_USER_KEY = "userId4logCookie"


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def field(arr: Column, i: int) -> Column:
    """Element ``i`` (0-based) of a split array, ``""`` when missing."""
    return F.coalesce(F.get(arr, i), F.lit(""))


def split_raw(value) -> Column:
    """B1: raw ``#CS#`` line -> struct of the 12 positional fields."""
    arr = F.split(_c(value), RAW_SEP, -1)
    return F.struct(*[field(arr, i).alias(n) for i, n in enumerate(RAW_FIELDS)])


def request_url(request_line) -> Column:
    """B2: second space-separated token of the request line, else ``""``."""
    return field(F.split(F.coalesce(_c(request_line), F.lit("")), " ", -1), 1)


def strip_cookie(cookie) -> Column:
    """Remove NUL and whitespace characters."""
    return F.regexp_replace(F.coalesce(_c(cookie), F.lit("")), r"[\x00\s]", "")


# Fixed value: what a character that is no hexadecimal digit counts as.
NO_DIGIT = 0x3F


def _digit(ch: Column) -> Column:
    """Value of one hexadecimal digit; other characters below 256 count as
    ``NO_DIGIT``, those beyond have no value."""
    at = F.position(F.upper(ch), F.lit("0123456789ABCDEF")) - 1
    return F.when((F.length(ch) == 1) & (at >= 0), at).when(F.ascii(ch) < 256, F.lit(NO_DIGIT))


def unescape(col) -> Column:
    """``%uXXXX`` (UTF-16 unit) and ``%XX`` (Latin-1) unescape.

    Digits are shifted together as they come, whatever they are (see
    ``NO_DIGIT``): ``%zz`` is one character too.  A ``%`` with too few
    characters after it, or with one beyond Latin-1, makes the whole value
    NULL (the caller drops the key).
    """
    s = _c(col)
    # A surrogate pair is one token; half a pair is no character.
    pair = r"%u[dD][89abAB][0-9a-fA-F]{2}%u[dD][c-fC-F][0-9a-fA-F]{2}"
    toks = F.regexp_extract_all(s, F.lit(rf"{pair}|%u[\s\S]{{4}}|%[^u][\s\S]|%[\s\S]*|[^%]+"), 0)

    def unit(t: Column, first: int, n: int) -> Column:
        code = F.lit(0)
        for i in range(n):
            code = F.shiftleft(code, 4).bitwiseOR(_digit(F.substring(t, first + i, 1)))
        code = code.bitwiseAND(F.lit(0xFFFF))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
        return F.when((code >= 0xD800) & (code <= 0xDFFF), F.lit("?")).otherwise(char)

    def dec(t: Column) -> Column:
        return (F.when(~t.startswith("%"), t)
                .when(t.rlike(f"^{pair}$"), F.decode(F.unhex(F.replace(t, F.lit("%u"), F.lit(""))), "UTF-16BE"))
                .when(t.startswith("%u") & (F.length(t) == 6), unit(t, 3, 4))
                .when(~t.startswith("%u") & (F.length(t) == 3), unit(t, 2, 2)))

    parts = F.transform(toks, dec)
    return F.when(F.exists(parts, lambda p: p.isNull()), F.lit(None).cast("string")) \
            .otherwise(F.array_join(parts, ""))


def escape(col) -> Column:
    """B5, the other way: letters, digits and ``-_.!~*'()`` stay, other
    ASCII becomes ``%XX`` and each further UTF-16 unit ``%uXXXX``."""
    def enc(c: Column) -> Column:
        units = F.hex(F.encode(c, "UTF-16BE"))
        return (F.when(c.rlike(r"^[A-Za-z0-9\-_.!~*'()]$"), c)
                .when((F.length(units) == 4) & (units < "0080"), F.concat(F.lit("%"), F.substring(units, 3, 2)))
                .otherwise(F.regexp_replace(units, "(.{4})", "%u$1")))
    return F.array_join(F.transform(F.regexp_extract_all(_c(col), F.lit(r"[\s\S]"), 0), enc), "")


def url_decode(col) -> Column:
    """UTF-8 URL decode; NULL when the text is not decodable."""
    return F.try_url_decode(_c(col))


def _kv_entries(pairs: Column, decode) -> Column:
    """``k=v`` strings -> array<struct<k,v>> (entries with a value only).

    Java ``split`` drops trailing empty strings, so ``k=`` has no value and
    ``k=v=w`` takes ``v``; entries whose value fails to decode are dropped.
    """
    kv = F.transform(pairs, lambda p: F.split(p, "=", -1))
    has_value = F.filter(kv, lambda a: F.exists(F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(1))),
                                                 lambda t: t != ""))
    ents = F.transform(has_value, lambda a: F.struct(F.get(a, 0).alias("k"),
                                                     decode(F.get(a, 1)).alias("v")))
    return F.filter(ents, lambda e: e["v"].isNotNull())


def last_wins_map(entries: Column) -> Column:
    """Entries -> map where the last duplicate key wins (a plain
    ``map_from_entries`` raises on duplicates under the default policy)."""
    placed = F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i"), e["v"].alias("v")))
    # One sort, bound to a lambda variable so that it is not run per entry.
    last = F.transform(F.array(F.array_sort(placed)), lambda s: F.filter(
        s, lambda e, i: F.coalesce(F.get(s, i + 1)["k"] != e["k"], F.lit(True))))[0]
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))


def _cookie_decode(v: Column) -> Column:
    return F.when(v.rlike("u[0-9a-fA-F]{4}"), unescape(v)).otherwise(url_decode(v))


def cookie_entries(cookie) -> Column:
    s = strip_cookie(cookie)
    pairs = F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, ";", -1))
    return _kv_entries(pairs, _cookie_decode)


def cookie_map(cookie) -> Column:
    """Cookie text -> map; the last duplicate key wins."""
    return last_wins_map(cookie_entries(cookie))


def last_value(entries: Column, key: str, default: str | None = "NULL") -> Column:
    """Value of the last entry with ``key``, else ``default``."""
    hits = F.filter(entries, lambda e: e["k"] == F.lit(key))
    v = F.when(F.size(hits) > 0, F.element_at(hits, -1)["v"])
    return F.coalesce(v, F.lit(default)) if default is not None else v


def url_params(url) -> Column:
    """Query string of a URL -> map (values not decoded, last wins)."""
    u = F.coalesce(_c(url), F.lit(""))
    q = field(F.split(u, r"\?", -1), 1)
    pairs = F.when(q == "", F.array().cast("array<string>")).otherwise(F.split(q, "&", -1))
    return last_wins_map(_kv_entries(pairs, lambda v: v))


def form_params(body) -> Column:
    """Form body -> map with URL-decoded values (bad values dropped, P25)."""
    b = F.coalesce(_c(body), F.lit(""))
    pairs = F.when(b == "", F.array().cast("array<string>")).otherwise(F.split(b, "&", -1))
    return last_wins_map(_kv_entries(pairs, url_decode))


def form_param(body, key: str, default: str = "") -> Column:
    """B8 + B13: one parameter of a form body, as in :func:`form_params`; other pairs are not decoded."""
    if "=" in key:
        return F.lit(default)
    b = F.coalesce(_c(body), F.lit(""))
    # As it is named twice, what makes a body stays compiled, outside the interpreted functions below.
    pairs = F.when(b == "", F.array().cast("array<string>")).otherwise(F.split(b, "&", -1))
    own = F.filter(pairs, lambda p: p.startswith(key + "="))
    texts = F.transform(own, lambda p: F.substring(p, F.lit(len(key) + 2), F.length(p)))
    values = F.transform(F.filter(texts, lambda t: F.ltrim(t, F.lit("=")) != ""),
                         lambda t: url_decode(F.substring_index(t, "=", 1)))
    return F.coalesce(F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1)), F.lit(default))


def json_map(col) -> Column:
    """JSON object -> map<string,string>; unparsable -> empty map."""
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.from_json(_c(col), "map<string,string>", {"mode": "PERMISSIVE"}), empty)


def _anew(text: Column) -> Column:
    """JSON as Spark writes it, in one more pair of brackets; NULL for other text."""
    return F.get_json_object(F.concat(F.lit("["), text, F.lit("]")), "$")


# A step that is one plain name, the only one read together with its descent, and a path of such steps alone.
_NAMED = re.compile(r"\.[A-Za-z_][\w-]*", re.ASCII)
_NAMES = re.compile(rf"\$(?:{_NAMED.pattern})+", re.ASCII)


def json_members(texts: Column, wanted: list[tuple[str | None, str, bool]]) -> Column:
    """Struct of each wanted (key, step, plain), see :func:`member_reader`, of a text written by :func:`_anew` or of an array of them.

    Texts are searched once for all keys, many together.  Text that is no JSON has none.
    """
    kinds = [*(f"v{i}: array<string>" for i in range(len(wanted))), "sure: boolean"]
    return F.arrow_udf(member_reader(wanted), f"struct<{', '.join(kinds)}>")(texts)


def read_together(paths) -> list[str]:
    """The paths that :func:`json_texts_of` reads at no cost of their own:
    descents, and names alone if a descent starts from the whole text."""
    paths = sorted({p for p in paths if p})
    whole = any(".." in p and not p.split("..")[0].rstrip("$.") for p in paths)
    return [p for p in paths if ".." in p or (whole and _NAMES.fullmatch(p))]


def json_texts(js, path: str) -> Column:
    """All matches of one JsonPath with recursive descent, see :func:`json_texts_of`."""
    return json_texts_of(js, [path])[path]


def json_texts_of(js, paths: list[str]) -> dict[str, Column]:
    """All matches of JsonPaths with recursive descent (``..key``) as
    texts, strings without their quotes, in the order of the document.

    Before, between and after the descents stand plain steps
    (``$.a..b.c``); a missing step gives no match.  A member that is JSON
    null is a null item.  Paths that descend from the same place share one
    reading of the text.
    """
    def descended(places: dict[str, tuple[Column, list[str]]], along: list[str] = ()) -> dict[str, Column]:
        """``places``: path -> (texts to descend from, steps left); texts that are one object are read together,
        the whole text with the paths ``along``."""
        out, groups = {}, {}
        for path, (texts, steps) in places.items():
            groups.setdefault(id(texts), (texts, {}))[1][path] = steps
        further = {}
        for texts, steps_of in groups.values():
            heads = {}
            for path, steps in steps_of.items():
                cut = min([k for k in (steps[0].find("."), steps[0].find("[")) if k > 0], default=len(steps[0]))
                heads[path] = steps[0][:cut], steps[0][cut:]
            # A plain step is read with its descent; the end of a path gives its members as they are.
            ask = {path: (key, rest[1:], True) if _NAMED.fullmatch(rest) else (key, "", not rest and len(steps_of[path]) == 1)
                   for path, (key, rest) in heads.items()}
            names = along if texts is whole else []
            wanted = [*dict.fromkeys(ask.values()), *((None, p[2:], True) for p in names)]
            read = json_members(texts, wanted)
            members = {w: read[f"v{i}"] for i, w in enumerate(wanted)}
            # Other texts may have a value before the place where they are no JSON.
            out |= {p: F.when(read["sure"], members[None, p[2:], True]).otherwise(plain[p]) for p in names}
            again = {}
            for path, (key, rest) in heads.items():
                found = members[ask[path]]
                if rest and not ask[path][1]:
                    found = F.filter(F.transform(found, lambda x: F.get_json_object(x, "$" + rest)), lambda x: x.isNotNull())  # noqa: B023
                if len(steps_of[path]) > 1:
                    further[path] = again.setdefault((key, rest), F.transform(found, _anew)), steps_of[path][1:]
                else:
                    out[path] = found
        return out | (descended(further) if further else {})

    plain, texts = {}, {}
    for path in paths:
        head, *steps = path.split("..")
        head = head if head.rstrip("$.") else ""
        base = F.get_json_object(_c(js), head) if head else _c(js)
        if steps:
            texts.setdefault(head, _anew(base))
        else:
            plain[path] = F.filter(F.array(base), lambda x: x.isNotNull())
    whole = texts.get("")
    heads_of = {p: p.split("..") for p in paths if ".." in p}
    return plain | descended({p: (texts[h if h.rstrip("$.") else ""], steps) for p, (h, *steps) in heads_of.items()},
                             [p for p in plain if whole is not None and _NAMES.fullmatch(p)])


def json_field(col, path) -> Column:
    """JsonPath field of a JSON text, ``""`` when missing.

    ``path`` may be a column (one rule per row) as well as a literal; a
    literal may hold a recursive descent, which gives its first match.
    """
    if isinstance(path, str) and ".." in path:
        return F.coalesce(F.get(json_texts(col, path), F.lit(0)), F.lit(""))
    p = F.lit(path) if isinstance(path, str) else path
    return F.coalesce(F.call_function("get_json_object", _c(col), p), F.lit(""))


def param(m: Column, key: str, default: str = "") -> Column:
    """Map lookup with a default."""
    return F.coalesce(F.element_at(m, F.lit(key)), F.lit(default))


def travel_id_text(v: Column) -> Column:
    """Travel type text -> int, blank / non-numeric -> -1."""
    return F.coalesce(F.trim(v).try_cast("int"), F.lit(-1))


def serialise_processed(df_cols: dict[str, Column] | None = None) -> Column:
    """18 fields -> ``#CS#`` text; empty and NULL become ``NULL``."""
    cols = df_cols or {n: F.col(n) for n in PROCESSED_FIELDS}
    return F.concat_ws(RAW_SEP, *[
        F.when(cols[n].isNull() | (cols[n].cast("string") == ""), F.lit("NULL"))
         .otherwise(cols[n].cast("string")) for n in PROCESSED_FIELDS])


def parse_processed(value) -> Column:
    """``#CS#`` text -> struct of the 18 processed fields, as texts."""
    arr = F.split(_c(value), RAW_SEP, -1)
    return F.struct(*[F.get(arr, i).alias(n) for i, n in enumerate(PROCESSED_FIELDS)])


def parse_record(value) -> Column:
    """``#CS#`` text -> the nested record (M3).

    The high-frequency flag is a boolean, type names stand beside their
    ids, the query record is parsed from its JSON (NULL if it is none) and
    the booking record is not read.
    """
    p = parse_processed(value)
    known = lambda c, ids: F.when(p[c].isin(*ids), p[c]).otherwise("Other" if "Other" in ids else "Unknown")
    return F.struct(
        *[p[c].alias(c) for c in ("requestMethod", "request", "remoteAddr", "httpUserAgent", "timeIso8601", "serverAddr")],
        (F.lower(p["highFrqIPGroup"]) == "true").alias("highFrqIPGroup"),
        F.struct(known("flightType", FLIGHT_TYPE_IDS).alias("flightType"),
                 known("behaviorType", BEHAVIOR_TYPE_IDS).alias("behaviorType")).alias("requestType"),
        known("travelType", TRAVEL_TYPE_IDS).alias("travelType"),
        F.struct(p["flightDate"].alias("flightDate"), p["depcity"].alias("depcity"), p["arrcity"].alias("arrcity"))
        .alias("requestParams"),
        p["JSESSIONID"].alias("cookieValue_JSESSIONID"), p["USERID"].alias("cookieValue_USERID"),
        F.from_json(F.nullif(p["queryRequestDataStr"], F.lit("NULL")), QUERY_RECORD).alias("queryRequestData"),
        F.lit(None).cast(BOOK_RECORD).alias("bookRequestData"), p["httpReferrer"].alias("httpReferrer"))
