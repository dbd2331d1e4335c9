"""Model scoring and reranking.

M3/U1 call user Python code through Arrow batches: ``mapInPandas``
builds the model once per partition (not per row); an input that fails
yields an empty response plus the error text, as the reference's
generation wrapper does for each prompt.  M5 is a top-k per item done in two stages
(salted partial top-k, then the final top-k), so an item with a third
of all candidates never sorts in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package


def batch_score(df: DataFrame, model_factory: Callable[[], Callable[[list[str]], list]],
                input_col: str, key: str, out_col: str = "response", out_type: str = "string") -> DataFrame:
    """M3: distributed batch inference with a user model.

    ``model_factory()`` runs once per partition and returns a function
    from a list of inputs to a list of outputs.  Output rows:
    ``(key, out_col, error)``; the key keeps its type and ``out_type``
    names the output's (``"string"``, ``"array<double>"`` for logits,
    ``"struct<label:int,score:double>"`` with dictionaries, ...).

    A call that fails is repeated on both halves of its inputs, so only
    the inputs that fail by themselves lose their output (empty for
    strings, NULL otherwise) and carry the error.
    """
    ship_package(df.sparkSession)
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField(out_col, T._parse_datatype_string(out_type)),
                           T.StructField("error", T.StringType())])
    blank = "" if out_type == "string" else None

    def answers(model, inputs: list[str]) -> list[tuple]:
        if not inputs:
            return []
        try:
            outs = list(model(inputs))
            if len(outs) != len(inputs):
                raise ValueError(f"{len(outs)} outputs for {len(inputs)} inputs")
            return [(o, None) for o in outs]
        except Exception as e:  # noqa: BLE001  (reported in the error column)
            if len(inputs) == 1:
                return [(blank, f"{type(e).__name__}: {e}")]
            half = len(inputs) // 2
            return answers(model, inputs[:half]) + answers(model, inputs[half:])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()
        for pdf in batches:
            outs, errors = zip(*answers(model, pdf[input_col].fillna("").tolist())) if len(pdf) else ((), ())
            yield pd.DataFrame({key: pdf[key], out_col: pd.Series(outs, pdf.index, dtype=object),
                                "error": pd.Series(errors, pdf.index, dtype=object)})

    return df.select(key, input_col).mapInPandas(run, schema)


def collate_batches(df: DataFrame, collate: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                    batch: str | list[str] = "batch_id") -> DataFrame:
    """``collate`` gets all rows of one batch (as D7 assigns them, in
    any order) and returns the batch's rows of type ``schema``.  ``batch``
    names the columns that make up a batch (its number, or the split and
    the number); a batch has as many rows as D7 was told."""
    ship_package(df.sparkSession)
    keys = [batch] if isinstance(batch, str) else list(batch)
    return df.groupBy(*keys).applyInPandas(collate, schema)


def pad_and_stack(ids: str = "ids", order: str = "id", pad: int = 1) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A collate function: the batch's sequences, in ``order``, padded to
    its longest and stacked; the decoder input (all but the last column) and
    the labels (all but the first) as nested arrays."""
    def collate(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [list(x) for x in pdf.sort_values(order)[ids]]
        longest = max(map(len, rows))
        block = [[int(v) for v in r] + [pad] * (longest - len(r)) for r in rows]
        keys = pdf.iloc[:1].drop(columns=[ids, order])
        return keys.assign(n_rows=len(block), padded_len=longest, inputs=[[r[:-1] for r in block]], labels=[[r[1:] for r in block]])
    return collate


def udf_tokenizer(tokenize: Callable[[str], list[str]]):
    """Wrap a user tokenizer ``str -> list[str]`` as an Arrow UDF.

    Texts become Python tokens a slice at a time and go back to Arrow at
    once, so a task holds the objects of one slice, not of a whole batch."""
    @F.arrow_udf("array<string>")
    def _tok(s: pa.Array) -> pa.Array:
        return tokenized(s, tokenize)
    return _tok


#: Bytes of text whose tokens are Python objects at a time (or one text).
SLICE_BYTES = 1 << 18


def tokenized(texts: pa.Array, tokenize: Callable[[str], list[str]]) -> pa.Array:
    before = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.unique(np.concatenate([[0], 1 + np.flatnonzero(np.diff(before // SLICE_BYTES)), [len(texts)]])).tolist()
    parts = [pa.array([None if x is None else list(tokenize(x)) for x in texts[lo:hi].to_pylist()], pa.list_(pa.string()))
             for lo, hi in zip(cuts[:-1], cuts[1:])]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int, tie_id: str,
                    salt_buckets: int = 64) -> DataFrame:
    """Exact top-k per group: top-k inside (group, salt) first, then overall."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(tie_id), F.lit(salt_buckets)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order)))
    pre = first.filter(F.col("_r") <= k).drop("_r", "_salt")
    final = pre.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return final.filter(F.col("rank") <= k)


def rerank_length_penalty(nbest: DataFrame, num_beams: int = 4, penalty: float = 0.7,
                          item: str = "item_id", cand: str = "cand_id") -> DataFrame:
    """M5: keep the best ``num_beams`` candidates per item by
    ``score / length ** penalty`` (ties keep candidate order, as a stable
    sort does); flag whether every kept candidate has ended."""
    scored = nbest.withColumn("norm", F.col("score") / F.pow(F.col("length").cast("double"), F.lit(penalty)))
    top = top_k_per_group(scored, item, [F.desc("norm"), F.col(cand)], num_beams, cand)
    return top.withColumn("all_finished", F.bool_and("ended").over(Window.partitionBy(item)))


def pick_best(nbest: DataFrame, num_beams: int = 4, penalty: float = 0.7, eos: int = 2, pad: int = 0,
              item: str = "item_id", cand: str = "cand_id", tokens: str = "tokens") -> DataFrame:
    """M5, last step: each item's best candidate, its tokens cut at the
    first ``eos`` (kept) and padded to the longest of all."""
    best = rerank_length_penalty(nbest, num_beams, penalty, item, cand).where("rank = 1")
    end = F.array_position(tokens, F.lit(eos))
    cut = F.when(end > 0, F.slice(tokens, F.lit(1), end.cast("int"))).otherwise(F.col(tokens))
    cut_rows = best.select(item, cand, "norm", "all_finished", cut.alias(tokens))
    longest = cut_rows.agg(F.coalesce(F.max(F.size(tokens)), F.lit(0))).scalar()
    return cut_rows.withColumn(tokens, F.concat(tokens, F.array_repeat(F.lit(pad), longest - F.size(tokens))))
