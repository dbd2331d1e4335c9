"""Answer extraction and self-consistency voting.

Extraction is per-row array/regex expressions.  Voting is a two-level
aggregation: ``(question, answer)`` counts with map-side partial sums
(a question with a third of all samples still splits across tasks),
then ``max_by`` per question -- no window, no collected groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import NUMERIC, WS, py_strip

THINK = r"(?s)<think>.*?</think>"
GOLD = "####" + WS + r"*([^\n]+)"

# The answer marker word and the sample counts of the sweep.
ANSWER_WORD = "Answer"
SWEEP_NS = (1, 3, 5, 10)


def gold_answer(answer: str | Column) -> Column:
    """Text after ``####`` up to the line end, stripped; NULL if no marker."""
    a = F.col(answer) if isinstance(answer, str) else answer
    return F.when(a.rlike(GOLD), py_strip(F.regexp_extract(a, GOLD, 1)))


def strip_think(text: str | Column) -> Column:
    """Drop ``<think>...</think>`` spans (an unclosed tag stays)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(t, THINK, "")


def llm_answer(df: DataFrame, text_col: str, out_col: str = "llm_answer") -> DataFrame:
    """The model's final answer.

    Non-blank stripped lines are scanned from the last: a numeric line is
    the answer; a line containing ``Answer`` yields its first numeric
    word (if none, scanning goes on); else the last line.  An empty
    response gives NULL.
    """
    t = df.withColumn("_lines", F.filter(
        F.transform(F.split(strip_think(text_col), "\n"), lambda x: py_strip(x)), lambda x: x != ""))

    def candidate(line: Column) -> Column:
        words = F.split(line, f"{WS}+")
        first_num = F.try_element_at(F.filter(words, lambda w: w.rlike(NUMERIC)), F.lit(1))
        return F.when(line.rlike(NUMERIC), line) \
            .when(line.contains(ANSWER_WORD), first_num)

    found = F.try_element_at(F.filter(F.transform(F.reverse("_lines"), candidate),
                                      lambda c: c.isNotNull()), F.lit(1))
    return t.withColumn(out_col, F.coalesce(found, F.try_element_at("_lines", F.lit(-1)))) \
        .drop("_lines")


def is_correct(gold: Column, pred: Column, match: str = "substring") -> Column:
    """C4: gold contained in the prediction (reference), or equal (``exact``).

    A missing gold answer counts as wrong but stays in the denominator (P5).
    """
    hit = pred.contains(gold) if match == "substring" else (pred == gold)
    return F.when(gold.isNotNull() & pred.isNotNull() & hit, 1).otherwise(0)


def majority_vote(samples: DataFrame, q: str = "question_id", answer: str = "answer",
                  idx: str = "sample_idx", by: list[str] | None = None) -> DataFrame:
    """Most frequent answer per question; ties -> the answer seen first."""
    keys = [*(by or []), q]
    per = samples.filter(F.col(answer).isNotNull()).groupBy(*keys, answer).agg(
        F.count("*").alias("votes"), F.min(idx).alias("first_idx"))
    return per.groupBy(*keys).agg(
        F.max_by(answer, F.struct(F.col("votes"), -F.col("first_idx"))).alias("voted"),
        F.max("votes").alias("votes"), F.sum("votes").alias("n_votes"))


def self_consistency_sweep(samples: DataFrame, gold: DataFrame, ns=SWEEP_NS,
                           q: str = "question_id", match: str = "substring") -> DataFrame:
    """Accuracy by number of samples n, all n in one job.

    Each sample is tagged with every n it belongs to (``sample_idx < n``):
    an ``explode`` of a literal list, no cross join.  Questions without a
    gold answer count in the denominator.
    """
    arr = F.array(*[F.lit(n) for n in ns])
    tagged = samples.withColumn("n", F.explode(F.filter(arr, lambda n: F.col("sample_idx") < n)))
    votes = majority_vote(tagged, q=q, by=["n"])
    qs = gold.select(q, "gold")
    grid = votes.join(qs, q, "right")
    per_n = grid.groupBy("n").agg(F.sum(is_correct(F.col("gold"), F.col("voted"), match)).alias("correct"))
    total = qs.agg(F.count("*")).scalar()
    return per_n.filter(F.col("n").isNotNull()).select(
        "n", F.col("correct").cast("long"), total.alias("questions"),
        (F.col("correct") / total).alias("accuracy"))
