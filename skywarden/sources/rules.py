"""Rule store (A6, A7, G6, E2, E3): rule tables -> rule snapshot.

Rule tables are read through one ``spark.read`` source: folders under one
root, one per table, or the tables of a relational database (``fmt="jdbc"``
with its reader options).  A missing table is an empty rule set (P9, P27).

A change is found by content: one job digests every table, and only those
whose digest differs are read again (the reference polls a change flag per
table every 5 s).  Edits and deletions count like additions, and no
version column is needed.

Streams take *pinned* snapshots.  The first attempt of a micro-batch notes
which copies of the tables it uses, and when; a replay after a crash finds
the note and runs with the same rules at the same time, whatever has been
edited since.  A copy is written only when a table has changed.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rules as R
from ..operators.etl import EtlRules, ParseRule
from . import folders
from .sinks import wall_clock

# Table names.
FILTER_TABLE = "nh_filter_rule"
CLASSIFY_TABLE = "nh_classify_rule"
ANALYZE_TABLE = "analyzerule"
IP_BLACKLIST_TABLE = "nh_ip_blacklist"
CRITICAL_PAGES_TABLE = "nh_query_critical_pages"
PROCESS_TABLE = "nh_process_info"
STRATEGY_TABLE = "nh_strategy"
RULE_TABLE = "nh_rule"
DICTIONARY_TABLE = "nh_rules_maintenance_table"

#: Tables of the three parts of a snapshot; a job pins those that it uses.
ETL_TABLES = [FILTER_TABLE, CLASSIFY_TABLE, ANALYZE_TABLE, IP_BLACKLIST_TABLE]
PAGE_TABLES = [CRITICAL_PAGES_TABLE]
FLOW_TABLES = [PROCESS_TABLE, STRATEGY_TABLE, RULE_TABLE, DICTIONARY_TABLE]
TABLES = ETL_TABLES + PAGE_TABLES + FLOW_TABLES

# Classify-rule (flight_type, operation_type) -> rule group.
CLASSIFY_GROUPS = {(0, 0): "nation_query", (1, 0): "internation_query",
                   (0, 1): "nation_book", (1, 1): "internation_book"}


def _filter_rules(df: DataFrame | None) -> list[str]:
    return [] if df is None else [r["value"] for r in df.select("value").collect()]


def _classify(df: DataFrame | None) -> dict[str, list[str]]:
    groups = {g: [] for g in CLASSIFY_GROUPS.values()}
    if df is not None:
        for r in df.select("expression", "flight_type", "operation_type").orderBy("id").collect():
            g = CLASSIFY_GROUPS.get((r["flight_type"], r["operation_type"]))
            if g:
                groups[g].append(r["expression"])
    return groups


def _analyze(df: DataFrame | None) -> tuple[list[ParseRule], list[ParseRule]]:
    query, book = [], []
    if df is None:
        return query, book
    for r in df.orderBy("id").collect():
        d = r.asDict()
        flag = lambda k: str(d.get(k, "false")).lower() == "true"  # noqa: E731, B023
        rule = ParseRule(
            rule_id=d["id"], method=d.get("request_method", ""), behavior_type=int(d["behavior_type"]),
            match=d.get("request_match_expression", ""), flight_type=int(d.get("flight_type", -1)),
            normal_get=flag("is_normal_get"), normal_form=flag("is_normal_form"),
            application_json=flag("is_application_json"), text_xml=flag("is_text_xml"),
            is_json=flag("is_json"), is_xml=flag("is_xml"), form_field=d.get("form_data_field") or "",
            query={k[6:]: v for k, v in d.items() if k.startswith("query_") and v},
            book={k[5:]: v for k, v in d.items() if k.startswith("book_") and v})
        (query if rule.behavior_type == 0 else book).append(rule)
    return query, book


def _critical_pages(df: DataFrame | None) -> list[str]:
    return [] if df is None else [r[0] for r in df.select("criticalPageMatchExpression").collect()]


def _flows(process: DataFrame | None, strategy: DataFrame | None, rule: DataFrame | None,
           dictionary: DataFrame | None) -> list:
    """Flow configuration; without rules a flow keeps an empty list, without flows there is none."""
    if process is None or strategy is None:
        return []
    spark = process.sparkSession
    rule = spark.createDataFrame([], R.RULE_SCHEMA) if rule is None else rule
    dictionary = spark.createDataFrame([], R.DICTIONARY_SCHEMA) if dictionary is None else dictionary
    return R.collect_flows(R.flows_of(process, strategy, rule, dictionary))


@dataclass
class Snapshot:
    """All rules of one moment; ``at`` is that moment on the session's wall clock."""
    etl: EtlRules
    flows: list
    critical_pages: list[str]
    hot_ips: DataFrame | None
    at: dt.datetime


@dataclass
class RuleStore:
    """``root`` holds one folder per table; with ``fmt="jdbc"`` the tables
    are read by ``options`` (url, user, driver …) and ``root`` is unused."""
    spark: SparkSession
    root: str = ""
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    _listed: dict = field(default_factory=dict)
    _loaded: dict = field(default_factory=dict)
    _copies: dict = field(default_factory=dict)
    _noted: dict = field(default_factory=dict)

    def reader_options(self, name: str) -> dict:
        """Options of ``spark.read`` for one table."""
        return dict(self.options) | ({"dbtable": name} if self.fmt == "jdbc" else {"path": f"{self.root.rstrip('/')}/{name}"})

    def table(self, name: str) -> DataFrame | None:
        o = self.reader_options(name)
        if "path" in o and not folders.exists(self.spark, o["path"]):
            return None
        return self.spark.read.format(self.fmt).options(**o).load()

    def _listing(self, name: str) -> str | None:
        """Names, sizes and times of a table's files: while they stay, so does its content."""
        o = self.reader_options(name)
        return folders.listing(self.spark, o["path"]) if "path" in o else None

    def digests(self, names: list[str] = TABLES) -> dict[str, str | None]:
        """Content digest of the tables, by one job over those whose files have changed; None where there is no table."""
        parts, marks = [], {}
        for name in names:
            marks[name] = self._listing(name)
            if marks[name] and self._listed.get(name, [None])[0] == marks[name]:
                continue
            self._listed.pop(name, None)
            df = self.table(name)
            if df is not None:
                h = F.xxhash64(*[F.col(c).cast("string") for c in sorted(df.columns)], F.lit("|".join(sorted(df.columns))))
                parts.append(df.agg(F.concat_ws(":", F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 40)))).alias("d"))
                             .select(F.lit(name).alias("name"), "d"))
        for r in reduce(DataFrame.unionByName, parts).collect() if parts else []:
            self._listed[r["name"]] = [marks[r["name"]], r["d"]]
        return {name: self._listed.get(name, [None, None])[1] for name in names}

    def _load(self, now: dict[str, str | None], table: Callable[[str], DataFrame | None]) -> tuple[EtlRules, list, list[str]]:
        """Parsed rules of the tables in ``now``; what is marked as in the last call is not read again."""
        def get(key: str, names: list[str], loader):
            mark = tuple(now.get(n) for n in names)
            if key not in self._loaded or self._loaded[key][0] != mark:
                self._loaded[key] = mark, loader(*[table(n) if now.get(n) else None for n in names])
            return self._loaded[key][1]

        query, book = get("analyze", [ANALYZE_TABLE], _analyze)
        etl = EtlRules(filter_rules=get("filter", [FILTER_TABLE], _filter_rules), query_rules=query, book_rules=book,
                       **get("classify", [CLASSIFY_TABLE], _classify))
        return etl, get("flows", FLOW_TABLES, _flows), get("pages", PAGE_TABLES, _critical_pages)

    def current(self) -> Snapshot:
        """The rules as they are now; tables that have not changed are not read again."""
        etl, flows, pages = self._load(self.digests(), self.table)
        return Snapshot(etl, flows, pages, self.hot_ips(), wall_clock(self.spark))

    def snapshot(self) -> EtlRules:
        return self.current().etl

    def flows(self) -> list:
        return self.current().flows

    def critical_pages(self) -> list[str]:
        return self.current().critical_pages

    def hot_ips(self) -> DataFrame | None:
        """nh_ip_blacklist as a DataFrame (joined, never collected)."""
        return self.table(IP_BLACKLIST_TABLE)

    # ------------------------------------------------------------- pinned

    def _note(self, pins: str, query: str, batch: int) -> str:
        return f"{pins}/query={query}/batch={batch}"

    def _read_note(self, path: str) -> dict | None:
        if not folders.exists(self.spark, f"{path}/_SUCCESS"):
            return None
        return json.loads(self.spark.read.text(path).first()["value"])

    def _copy(self, pins: str, query: str, name: str, df: DataFrame) -> str:
        """A copy that nobody edits; the hot list once per address."""
        path = f"{pins}/tables/{name}-{query}-{uuid.uuid4().hex}"
        (df.distinct() if name == IP_BLACKLIST_TABLE else df).write.parquet(path)
        return path

    def pinned(self, pins: str, query: str, batch: int, names: list[str] = TABLES) -> Snapshot:
        """The snapshot of micro-batch ``batch`` of ``query``, the same on every attempt.

        ``pins`` is a shared folder that lives as long as the query's
        checkpoint; ``names`` are the tables that the query uses, the others
        are empty.  Notes of batches that cannot be replayed any more, and
        copies that no note names, are removed.
        """
        path = self._note(pins, query, batch)
        note = self._read_note(path)
        if note is None:
            known = self._copies.setdefault((pins, query), {})
            for name, digest in self.digests(names).items():
                if digest is None:
                    known.pop(name, None)
                elif known.get(name, [None])[0] != digest:
                    known[name] = [digest, self._copy(pins, query, name, self.table(name))]
            note = {"at": wall_clock(self.spark).isoformat(), "tables": {n: c for n, (_, c) in known.items()}}
            self.spark.createDataFrame([(json.dumps(note),)], "value string").coalesce(1).write.mode("overwrite").text(path)
            self._forget(pins, query, batch, note)
        copies = note["tables"]
        # The name of a copy stands for its content: the table may have moved on between digest and copy.
        etl, flows, pages = self._load(copies, lambda name: self.spark.read.parquet(copies[name]))
        hot = copies.get(IP_BLACKLIST_TABLE)
        return Snapshot(etl, flows, pages, self.spark.read.parquet(hot) if hot else None, dt.datetime.fromisoformat(note["at"]))

    def _forget(self, pins: str, query: str, batch: int, note: dict) -> None:
        """Only the newest batch can run again; the one before is kept as well."""
        held = self._noted.setdefault((pins, query), {})
        held[batch] = set(note["tables"].values())
        kept = set()
        for b in map(int, folders.values(self.spark, f"{pins}/query={query}", "batch")):
            path = self._note(pins, query, b)
            if b < batch - 1:
                folders.delete(self.spark, path)
                held.pop(b, None)
                continue
            if b not in held:
                held[b] = set(((self._read_note(path) or {}).get("tables") or {}).values())
            kept |= held[b]
        kept = {copy.rsplit("/", 1)[1] for copy in kept}
        for name in folders.children(self.spark, f"{pins}/tables"):
            if f"-{query}-" in name and name not in kept:
                folders.delete(self.spark, f"{pins}/tables/{name}")


def write_rule_tables(spark: SparkSession, root: str, rules: EtlRules, version: int = 1,
                      critical_pages: list[str] | None = None, hot_ips: DataFrame | None = None,
                      process: DataFrame | None = None, strategy: DataFrame | None = None,
                      rule: DataFrame | None = None, dictionary: DataFrame | None = None) -> None:
    """Write a rule snapshot as rule tables (tests, bootstrap)."""
    def put(name: str, df: DataFrame) -> None:
        df.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")

    def save(name, rows, schema):
        put(name, spark.createDataFrame(rows, schema))

    save(FILTER_TABLE, [(i, v) for i, v in enumerate(rules.filter_rules)], "id int, value string")
    cls = []
    for (ft, op), g in CLASSIFY_GROUPS.items():
        for e in getattr(rules, g):
            cls.append((len(cls), e, ft, op))
    save(CLASSIFY_TABLE, cls, "id int, expression string, flight_type int, operation_type int")
    keys = sorted({f"query_{k}" for r in rules.query_rules for k in r.query}
                  | {f"book_{k}" for r in rules.book_rules for k in r.book})
    rows = []
    for r in rules.query_rules + rules.book_rules:
        d = {"id": r.rule_id, "request_method": r.method, "behavior_type": r.behavior_type,
             "request_match_expression": r.match, "flight_type": r.flight_type,
             "is_normal_get": str(r.normal_get).lower(), "is_normal_form": str(r.normal_form).lower(),
             "is_application_json": str(r.application_json).lower(), "is_text_xml": str(r.text_xml).lower(),
             "is_json": str(r.is_json).lower(), "is_xml": str(r.is_xml).lower(), "form_data_field": r.form_field}
        for k in keys:
            d[k] = (r.query if k.startswith("query_") else r.book).get(k.split("_", 1)[1], "")
        rows.append(d)
    cols = ["id", "request_method", "behavior_type", "request_match_expression", "flight_type",
            "is_normal_get", "is_normal_form", "is_application_json", "is_text_xml", "is_json", "is_xml",
            "form_data_field"] + keys
    schema = ", ".join(f"{c} {'int' if c in ('behavior_type', 'flight_type') else 'string'}" for c in cols)
    save(ANALYZE_TABLE, [tuple(d[c] for c in cols) for d in rows], schema)
    save(CRITICAL_PAGES_TABLE, [(p,) for p in (critical_pages or [])], "criticalPageMatchExpression string")
    for name, df in ((IP_BLACKLIST_TABLE, hot_ips), (PROCESS_TABLE, process), (STRATEGY_TABLE, strategy),
                     (RULE_TABLE, rule), (DICTIONARY_TABLE, dictionary)):
        if df is not None:
            put(name, df)
