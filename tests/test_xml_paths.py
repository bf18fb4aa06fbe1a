"""Plain paths read in one pass against Spark's XPath functions."""

import json
import random
from urllib.parse import quote

from pyspark.sql import functions as F

from skywarden.functions.xml import node_text, page_text, page_values, segtype_travel
from skywarden.operators import etl as E

_BITS = ["x", " ", "\n", "<a>", "</a>", "<b>", "</b>", "<c/>", "<![CDATA[q]]>", "<![CDATA[]]>", "<!--c-->", "<?p q?>", "&amp;", "&#65;",
         "&", "]]>", "<a>t</a>", "<b>t<a>u</a></b>", "<x:a>p</x:a>", "<a xmlns='u'>n</a>", "\r\n", "</page>", "<page>", "\x0b", "é",
         "\U0001F600", "&nbsp;", "&#0;", "<around-page></around-page>", "<a b='1' b='2'/>"]
_LISTS = {"l1": "/page/a", "l2": "//a", "l3": "/page/b/a", "l4": "//b/text()", "l5": "/page/*[2]"}
_FIRSTS = {"s1": "/page/a", "s2": "//a", "s3": "/page/b/a/text()", "s4": "//b/text()", "s5": "/page", "s6": "/page/no", "s7": "/page/a[2]"}


def _bodies(n: int) -> list:
    r = random.Random(7)
    weights = [4] * 11 + [1] * 5 + [5] * 4 + [1] * 10
    page = lambda: "".join(r.choices(_BITS, weights, k=r.randint(0, 7)))
    ends = ["</page>", "</page>", "</page >\n", "</page>x", ""]
    return [r.choice(["", "xml="]) + "<page>" + page() + r.choice(ends) for _ in range(n)] + [None, "", "<page/>", "<page></page>"]


def test_page_values_like_xpath(spark):
    page = page_text("x")
    old = F.when(page.isNotNull(), F.struct(*[F.xpath(page, F.lit(node_text(p))).alias(k) for k, p in _LISTS.items()],
                                            *[F.xpath_string(page, F.lit(p)).alias(k) for k, p in _FIRSTS.items()]))
    df = spark.createDataFrame([(x,) for x in _bodies(800)], "x string")
    rows = df.select("x", old.alias("old"), page_values("x", _LISTS, _FIRSTS).alias("new")).collect()
    assert sum(r["old"] is not None for r in rows) > 100
    assert [r["x"] for r in rows if r["old"] != r["new"]] == []


def test_deep_page(spark):
    body = "<page>" + "<a>" * 20_000 + "t" + "</a>" * 20_000 + "</page>"
    df = spark.createDataFrame([(body,)], "x string")
    assert df.select(page_values("x", {"l": "/page/b"}, {"s": "//a"}).alias("v")).first()["v"].asDict() == {"l": [], "s": "t"}


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_book_reads_a_page_once(spark):
    rule = E.ParseRule("B", "POST", 1, ".*", flight_type=0, text_xml=True, is_xml=True, book={
        "psgName": "/page/psg/name", "idCard": "/page/psg/id", "contractName": "/page/c", "contractPhone": "/page/p"})
    df = spark.createDataFrame([("<page><psg><name>A</name><id>1</id></psg><psg><name>B</name></psg><c>C|x</c><p>2/3</p></page>",),
                                ("<page>",)], "body string")
    src = E.book_source(rule, F.col("body"), F.lit("text/xml"))
    out = df.select(E.book_request([rule], F.lit(0), [src], F.lit(-1)).alias("b"))
    got = [r["b"] for r in out.collect()]
    assert [(g["psgName"], len(g["idCard"]), g["contractName"]) for g in got] == [(["A", "B"], 1, "C"), ([], 0, "")]
    assert "xpath" not in _plan(out).lower() and "from_xml" not in _plan(out).lower()


def test_query_reads_a_page_once(spark):
    rule = E.ParseRule("Q", "POST", 0, ".*", text_xml=True, is_xml=True, query={"depCity": "/page/dep", "arrCity": "/page/arr"})
    df = spark.createDataFrame([("x=<page><dep> a </dep><arr>b</arr></page>",), ("<page><dep>&</dep></page>",)], "body string")
    src = E.query_source(rule, F.lit("/q"), F.col("body"), F.lit("text/xml"))
    out = df.select(E.query_request([rule], F.lit(0), [src], F.lit(0), F.lit(-1)).alias("q"))
    assert [(r["q"]["isEmpty"], r["q"]["depCity"], r["q"]["arrCity"]) for r in out.collect()] == [(False, "a", "b"), (True, "", "")]
    assert "xpath" not in _plan(out).lower()


def test_flat_map_and_travel_type_read_a_page_once(spark):
    from skywarden.functions.xml import xml_flat_map
    df = spark.createDataFrame([("<page><SEGTYPE>S</SEGTYPE><n>1</n><n>2</n></page>tail",), ("<page></pag",)], "x string")
    travel = df.select(segtype_travel("x").alias("t"))
    flat = df.select(xml_flat_map(F.concat("x", F.lit("")), {"n": "/page/n"}).alias("m"),
                     xml_flat_map(F.substring_index("x", "tail", 1), {"n": "/page/n", "s": "//SEGTYPE"}).alias("k"))
    assert [r["t"] for r in travel.collect()] == ["OneWay", "Unknown"]
    assert [(r["m"], r["k"]) for r in flat.collect()] == [({}, {"n0": "1", "n1": "2", "s0": "S"}), ({}, {})]
    assert "xpath" not in (_plan(travel) + _plan(flat)).lower()


def test_orders_are_dealt_out(spark, tmp_path):
    """Payloads of a table in one block are built and parsed in several tasks."""
    from skywarden.plans import queries_xml as Q
    spark.range(4_000).selectExpr("id o_orderkey", "id % 999 o_custkey", "date'2024-01-01' o_orderdate") \
        .coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    for query in (Q.q_xml_travel, Q.q_xml_flat, Q.q_xml_book, Q.q_xml_query, Q.q_book_json, Q.q_form_json):
        assert "RebalancePartitions" in _plan(query(spark, str(tmp_path)))


def test_json_descents_share_one_reading(spark):
    """Paths from one place are read by one call, with keys at several depths, repeated and null."""
    from skywarden.functions.parsing import json_texts_of
    df = spark.createDataFrame([('{"a":{"b":"x","a":1.5},"l":[{"b":null},{"b":{"c":"\\"y"}}],"a":"z"}',), ("{'a':1",), (None,)], "js string")
    found = json_texts_of("js", ["$..a", "$..b", "$..b.c", "$.l..b", "$..a..b"])
    out = df.select(*[c.alias(p.strip("$").replace(".", "_")) for p, c in found.items()])
    assert out.collect()[0].asDict() == {"__a": ['{"b":"x","a":1.5}', "1.5", "z"], "__b": ["x", None, '{"c":"\\"y"}'],
                                         "__b_c": ['"y'], "_l__b": [None, '{"c":"\\"y"}'], "__a__b": ["x"]}
    assert [list(r) for r in out.collect()[1:]] == [[[]] * 5] * 2
    three = df.select(*[c.alias(f"c{i}") for i, c in enumerate(json_texts_of("js", ["$..a", "$..b", "$..b.c"]).values())])
    assert _plan(three).count("run(") == _plan(df.select(json_texts_of("js", ["$..a"])["$..a"].alias("c"))).count("run(")


def _members(value, key):
    """Members of a key at any depth, outer before inner, by recursion; objects are lists of pairs."""
    for k, v in value if isinstance(value, tuple) else []:
        if k == key:
            yield v
        yield from _members(v, key)
    for v in value if isinstance(value, list) else []:
        yield from _members(v, key)


def _written(value) -> str:
    if isinstance(value, tuple):
        return "{" + ",".join(f"{_written(k)}:{_written(v)}" for k, v in value) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def test_members_of_many_texts_like_recursion(monkeypatch):
    """Texts searched together, in blocks of a few, against one text after the other."""
    import pyarrow as pa
    from skywarden.functions import members as M
    r = random.Random(5)
    keys = ["a", "b", ",", "\u00e9\"", "", "ab", ":a", "}"]
    words = ["", "a", '"', "\\", '\\"', ',"a":', '{"a":1', "}]", "null", "\u00e9\n", "\\\\", 'x,', 1, -2.5, True, None, 0]

    def value(depth: int):
        kind = r.random() if depth else 1
        return (tuple((r.choice(keys), value(depth - 1)) for _ in range(r.randint(0, 4))) if kind < .5
                else [value(depth - 1) for _ in range(r.randint(0, 3))] if kind < .7 else r.choice(words))

    rows = [[[value(5)] for _ in range(r.randint(0, 3))] if r.random() < .9 else None for _ in range(400)]
    shown = lambda v: v if isinstance(v, str) or v is None else _written(v)
    steps = lambda v: [w for k, w in v if k == "b" and w is not None][:1] if isinstance(v, tuple) else []
    wanted = [(k, "", plain) for k in keys for plain in (True, False)] + [("a", "b", True), ("ab", "b", False)]
    monkeypatch.setattr(M, "BLOCK_BYTES", 200)
    found = M.member_reader(wanted)(pa.array([t and [_written(v) for v in t] for t in rows], pa.list_(pa.string()))).to_pylist()
    one = M.member_reader(wanted)(pa.array(["[]", *[_written(t[0]) if t else None for t in rows]], pa.string()).slice(1)).to_pylist()
    for row, got, first in zip(rows, found, one, strict=True):
        for i, (key, step, plain) in enumerate(wanted):
            for texts, had in ((row or [], got), ((row or [])[:1], first)):
                hits = [v for t in texts for v in _members(t, key)]
                hits = [w for v in hits for w in steps(v)] if step else hits
                assert had[f"v{i}"] == [shown(v) if plain else _written(v) for v in hits]
    none = M.member_reader(wanted)(pa.array([], pa.string()))
    assert len(none) == 0 and none.type == pa.struct([*((f"v{i}", pa.list_(pa.string())) for i in range(len(wanted))), ("sure", pa.bool_())])


def test_form_param_like_form_params(spark):
    from skywarden.functions.parsing import form_param, form_params, param
    bodies = ["json=%5B1%5D", "a=1&json=x&json=", "json=x&json=y=z", "json==", "json==v", "json", "=json", "json=%zz", "json=x&json=%zz", "&json=+a+&",
              "xjson=1&json2=3", "json=\u00e9%C3%A9\U0001F600", "json=x=", "", None, "json=1\n&json=\n", "j.on=1"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    for key in ("json", "j.on", "a=1", "", "\u00e9"):
        rows = df.select("body", form_param("body", key).alias("new"), param(form_params("body"), key, "").alias("old")).collect()
        assert [r["body"] for r in rows if r["new"] != r["old"]] == []


def test_json_book_reads_no_member_or_pair_alone(spark):
    """A body is written anew once per place; members are not read one by one, and no map is made of a form."""
    rule = E.ParseRule("B", "POST", 1, ".*", flight_type=0, is_json=True, form_field="json", book={
        "psgFirName": "$..fir", "psgName": "$..name", "idType": "$..doc.type", "idCard": "$..id", "contractPhone": "$..phone"})
    js = '[{"psgs":[{"fir":"A","name":"B","doc":{"type":null,"type":"ID","id":1}},{"fir":null,"name":"\\"C","doc":{"id":"2"}},{"doc":[]}],"phone":3}]'
    df = spark.createDataFrame([("x=1&json=" + quote(js),), ("json=%5B%7B",), ("json",), (None,)], "body string")
    out = df.select(E.book_request([rule], F.lit(0), [E.book_source(rule, F.col("body"), F.lit(""))], F.lit(-1)).alias("b"))
    got = [r["b"] for r in out.collect()]
    assert [(g["psgName"], g["idType"], len(g["idCard"])) for g in got] == [(["AB", 'null"C'], ["ID"], 2), ([], [], 0), ([], [], 0), ([], [], 0)]
    assert "get_json_object(lambda" not in _plan(out) and "map_from_entries" not in _plan(out)


def test_names_read_along_like_get_json_object(spark):
    """Paths of names read with a descent against Spark's own function, with repeated, null, malformed and trailing parts."""
    from skywarden.functions.parsing import json_texts_of, read_together
    r = random.Random(3)
    words = ['"x"', "1", "1.50", "1e400", "-0", "null", "true", '"null"', '""', '"a\\"b"', '"\\u00e9\\n"', "'y'", '"NaN"', "NaN", "[1,{\"a\":2}]", "[]", "{}",
             "12345678901234567890123", '"Infinity"', "{\"b\":", "01"]

    def value(depth: int) -> str:
        if not depth or r.random() < .35:
            return r.choices(words, [3] * (len(words) - 2) + [1] * 2)[0]
        pairs = [f'{r.choice(["", " "])}"{r.choice("aab")}": {value(depth - 1)}' for _ in range(r.randint(0, 3))]
        return "{" + ",".join(pairs) + "}"

    docs = [value(4) + r.choice([""] * 6 + [" x", ',{"a":1}', "],[", "}", "]"]) for _ in range(1500)]
    docs += [None, "", " ", "[", "]", '1],[{"a":2}', ',{"a":1}', '[{"a":1}]', '{"a":1', "{'a':{'b':2}}", '{"a":"x"', '{"a":1}{"a":2}']
    paths = ["$.a", "$.b", "$.a.b", "$.b.a", "$.a.a.b"]
    assert read_together(["$..a", "", None, *paths, "$.a[0]", "$.*"]) == sorted(["$..a", *paths])
    assert read_together(["$.a..b", "$.a"]) == ["$.a..b"]
    found = json_texts_of("js", ["$..a", *paths])
    df = spark.createDataFrame([(d,) for d in docs], "js string")
    rows = df.select("js", F.array(*[F.get_json_object("js", p) for p in paths]).alias("old"),
                     F.array(*[F.get(found[p], F.lit(0)) for p in paths]).alias("new")).collect()
    assert sum(v is not None for r in rows for v in r["old"]) > 500
    assert [r for r in rows if r["old"] != r["new"]] == []


def test_rules_of_equal_paths_are_read_as_one(spark):
    book = {"bookUserId": "$.u", "psgFirName": "$..f", "psgName": "$..n"}
    rules = [E.ParseRule("B", "POST", 1, "/a", flight_type=0, application_json=True, is_json=True, book=book),
             E.ParseRule("C", "POST", 1, "/b", flight_type=1, is_json=True, form_field="j", book={**book, "cabin": ""}),
             E.ParseRule("D", "POST", 1, "/c", flight_type=1, is_json=True, form_field="j", book={"bookUserId": "$..f"})]
    js = '{"u":"U","f":"A","n":"B"}'
    df = spark.createDataFrame([(i, js if i == 0 else "j=" + quote(js)) for i in (0, 1, 2, 3)] + [(0, "{"), (1, "j={")], "i int, body string")
    out = df.select(E.book_request(rules, F.col("i"), [E.book_source(r, F.col("body"), F.when(F.col("i") == 0, "application/json").otherwise(""))
                                                       for r in rules], F.lit(9)).alias("b"))
    got = [(b["flightType"], b["travelType"], b["bookUserId"], b["psgName"]) for (b,) in out.collect()]
    assert got == [(0, 9, "U", ["AB"]), (1, 9, "U", ["AB"]), (1, 9, "A", []), (-1, -1, "", []), (0, 9, "", []), (1, 9, "", [])]
    assert _plan(out).count("run(") == 2
