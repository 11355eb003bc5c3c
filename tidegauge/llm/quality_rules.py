"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each rule rejects a text whose feature exceeds a cutoff. Cutoffs are chosen per stratum (language) on the labelled
texts: among the texts labelled good, the share that a rule may reject has to be at most ``risk`` / number of rules, at
confidence 1 - ``delta``. For n good texts of which k are rejected, the exact (Clopper-Pearson) upper bound is at most r
just when P(Binomial(n, r) <= k) <= delta'. The cutoffs of a fixed grid are tried from the most lenient on until the
first that fails (a fixed sequence, which needs no correction along the grid), and delta' = delta / (strata * rules) is
the Bonferroni correction over the rest. A stratum with too few good texts for any guarantee gets no cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import SPACES, materialize, squeeze, text_of, words

#: Rule: grid of cutoffs in thousandths, from lenient to strict; a text fails when its feature is above.
GRID = 100
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
RISK = 0.02
DELTA = 0.05


def counts(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the size-free inputs of the rules."""
    text = text_of()
    base = docs.select("doc_id", *carry, text.alias("_t")).select("*", words(F.col("_t")).alias("_w"))
    windows = F.when(
        F.size("_w") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("_w") - 3),
            lambda i: F.struct(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i")),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    base = base.withColumn("_s", F.sort_array(windows))
    same = lambda x, k: (F.get("_s", k - 1)["h"] == x["h"]) | (F.get("_s", k + 1)["h"] == x["h"])
    base = base.withColumn("_r", F.sort_array(F.transform(F.filter("_s", lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"])))
    # a window covers three words, or up to the next repeated window's start where that comes sooner
    covered = F.aggregate(
        F.transform("_r", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("_r", k + 1) - i, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(squeeze(x)) > 0)
    long = lambda c: c.cast("long")
    return base.select(
        "doc_id",
        *carry,
        long(F.size("_w")).alias("n_words"),
        long(F.length(squeeze(F.col("_t")))).alias("word_chars"),
        long(F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        long(covered).alias("n_repeat_words"),
        long(F.length("_t") - F.length(F.translate("_t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("n_capitals"),
        long(F.size(lines)).alias("n_lines"),
    )


def features() -> dict[str, Column]:
    """Rules' features as whole thousandths (0 for a text without words)."""
    share = lambda a, b: F.when(F.col(b) > 0, F.least(F.lit(1000), F.floor(F.col(a) * 1000 / F.col(b)))).otherwise(0).cast("int")
    return {
        "symbols": share("n_symbols", "word_chars"),
        "capitals": share("n_capitals", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def allowed_failures(n: Column, rate: float, delta: Column) -> Column:
    """The largest k with P(Binomial(n, rate) <= k) <= delta; -1 where there is none."""
    import math

    odds = math.log(rate / (1 - rate))
    top = F.greatest(F.lit(0), F.ceil(n * F.lit(rate)).cast("int"))
    start = F.struct((n * F.lit(math.log1p(-rate))).alias("term"), F.lit(0.0).alias("below"), F.lit(-1).alias("k"), F.lit(False).alias("over"))

    def step(s: Column, i: Column) -> Column:
        below = s["below"] + F.exp(s["term"])
        over = s["over"] | (below > delta)
        # term of i + 1 from that of i
        term = s["term"] + F.log((n - i + F.lit(1e-300)) / (i + 1)) + F.lit(odds)
        return F.struct(term.alias("term"), below.alias("below"), F.when(over, s["k"]).otherwise(i).alias("k"), over.alias("over"))

    return F.aggregate(F.sequence(F.lit(0), top), start, step)["k"]


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: float, delta: float) -> DataFrame:
    """_stratum and one cutoff column per rule (null: no cutoff can be guaranteed)."""
    rules = features()
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("_q")).where("_q = 1").select("doc_id")
    held = measured.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"), *(c.alias(k) for k, c in rules.items())).join(good, "doc_id")
    long = held.select(
        "_stratum",
        F.explode(F.array(*(F.struct(F.lit(k).alias("_rule"), F.ceil(F.col(k) * GRID / 1000).cast("int").alias("_cell")) for k in rules))).alias("_x"),
    )
    cells = long.groupBy("_stratum", "_x._rule", "_x._cell").agg(F.count("*").alias("_n"))
    # a text of cell c is above the cutoffs of the cells below c
    whole = Window.partitionBy("_stratum", "_rule")
    down = whole.orderBy(F.desc("_cell"))
    strata = cells.select("_stratum").distinct().agg(F.count("*").alias("_strata"))
    sums = (
        cells.withColumn("_all", F.sum("_n").over(whole))
        .withColumn("_above", F.sum("_n").over(down) - F.col("_n"))
        .crossJoin(strata)  # one row
        .withColumn("_may", allowed_failures(F.col("_all"), risk / len(rules), F.lit(delta) / (F.col("_strata") * len(rules))))
    )
    # the lowest cell whose cutoff still has few enough good texts above it
    least = sums.where((F.col("_above") <= F.col("_may")) & (F.col("_may") >= 0)).groupBy("_stratum").agg(
        *(F.min(F.when(F.col("_rule") == k, F.col("_cell"))).alias(f"_cut_{k}") for k in rules)
    )
    return least


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row.

    base_failed: fewer than 50 words, or over half of the words in repeated three-word windows. Others stay unless a
    rule's feature is above its stratum's cutoff. Null texts have no words and fail; a null stratum is a stratum of its
    own; texts of a stratum without cutoffs stay. Several labels of a doc_id count as good if one of them is. Rows
    with the same doc_id are judged one by one. Columns other than doc_id, text and the stratum are ignored.
    """
    measured = materialize(counts(docs, stratum), "quality-counts")
    rules = features()
    # as each stratum with a cutoff has over a hundred labelled texts, the table is far smaller than the labels
    cuts = F.broadcast(materialize(cutoffs(measured, labels, stratum, risk, delta), "quality-cutoffs"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    above = [F.coalesce(F.ceil(c * GRID / 1000) > F.col(f"_cut_{k}"), F.lit(False)) for k, c in rules.items()]
    rejected = above[0]
    for a in above[1:]:
        rejected = rejected | a
    joined = measured.join(cuts, F.coalesce(measured[stratum].cast("string"), F.lit("")) == cuts["_stratum"], "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~rejected).alias("kept"),
    )
