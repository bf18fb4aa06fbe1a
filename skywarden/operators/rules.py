"""Rule tables -> flow configuration.

Rule tables are small configuration (a web form edits them), but they are
still handled as DataFrames: one join per relation instead of the N+1
lookups a row-at-a-time loader would do.  ``collect_flows`` is the single
place where configuration reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the rule tables that are read (others may stand beside them).
RULE_SCHEMA = "id string, process_id string, rule_name string, crawler_type int, status int, arg0 double, arg1 double, score int"
DICTIONARY_SCHEMA = "rule_name string, rule_real_name string"


def active_processes(process: DataFrame, strategy: DataFrame) -> DataFrame:
    """Process x strategy (same id), enabled processes only."""
    s = strategy.select(F.col("id").alias("__id"), F.col("crawler_blacklist_thresholds").cast("double").alias("flow_limit"))
    return (process.filter(F.col("status") == 0)
            .join(s, process["id"] == s["__id"], "inner")
            .select(F.col("id").alias("flow_id"), F.col("process_name").alias("flow_name"), "flow_limit"))


def crawler_rules(rules: DataFrame, dictionary: DataFrame) -> DataFrame:
    """E5: rule x rule-name dictionary, crawler rules (crawler_type 0) only.

    Rules follow one another by ``rule_order`` where the table has it, and
    by their id.
    """
    order = F.col("rule_order").cast("int") if "rule_order" in rules.columns else F.lit(0)
    names = dictionary.select("rule_name", "rule_real_name")
    return (rules.filter(F.col("crawler_type") == 0)
            .join(names, "rule_name", "inner")
            .select("process_id", order.alias("rule_order"), F.col("id").alias("rule_id"),
                    F.col("rule_real_name").alias("rule_name"),
                    F.col("status").cast("int").alias("rule_status"),
                    F.col("arg0").cast("double").alias("arg0"), F.col("arg1").cast("double").alias("arg1"),
                    F.col("score").cast("int").alias("score")))


def flow_config(flows: DataFrame, rules: DataFrame) -> DataFrame:
    """Nest rules under their flow; flows without rules keep ``[]``."""
    nested = (rules.groupBy("process_id")
              .agg(F.sort_array(F.collect_list(F.struct(
                  "rule_order", "rule_id", "rule_name", "rule_status", "arg0", "arg1", "score"))).alias("rules")))
    j = flows.join(nested, flows["flow_id"] == nested["process_id"], "left")
    empty = F.array().cast(nested.schema["rules"].dataType)
    return j.select("flow_id", "flow_name", "flow_limit", F.coalesce("rules", empty).alias("rules"))


def flows_of(process: DataFrame, strategy: DataFrame, rules: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The four rule tables -> flows with their rules."""
    return flow_config(active_processes(process, strategy), crawler_rules(rules, dictionary))


def collect_flows(flows: DataFrame) -> list:
    """Flow configuration as Python rows, in flow order.

    The configuration is what people have entered, not data: it is read
    whole, however many rules it has, and becomes one constant of the
    scoring projection (no join, no shuffle).
    """
    return flows.orderBy("flow_id").collect()


def flow_model_list(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Flow x model inner join, ordered by model then flow name.

    Nations play the flows, regions the models they belong to.
    """
    return (nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner")
            .select(F.col("n_nationkey").alias("flow_num"), F.col("n_name").alias("flow_name"),
                    F.col("r_regionkey").alias("model_id"), F.col("r_name").alias("model_name"))
            .orderBy(F.col("model_id").desc(), "flow_name"))


def flow_directory(process: DataFrame) -> DataFrame:
    """H9: flow directory ordered by number."""
    return process.select("process_num", "id", "process_name", "status").orderBy("process_num")
