"""Vocabulary and sequence encoding.

Encoded sequences are ``array<int>`` columns; every transformation after
the id lookup is a per-row array expression (no shuffle).  The lookup is
one too (``operators.vocab``) while the vocabulary is under a size that is
checked; beyond it that holds for the frequent tokens, and the rare ones are
exploded, joined to the rest of the vocabulary and put in their places; a
row's tokens are bounded by its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import vocab as packed_vocab
from tessera.plans.ranking import global_rank
from tessera.session import ensure_checkpoint_dir, ship_package

# Special tokens and their ids, in this order.
SPECIALS = ["<unk>", "<pad>", "<bos>", "<eos>"]
UNK, PAD, BOS, EOS = 0, 1, 2, 3
IGNORE = -100


def build_vocab(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """``(token, id, freq)``: specials 0-3, then count desc, token asc.

    ``tokens`` has one row per token occurrence of the *train* split.
    Ids come from a distributed gap-free rank (no single-task window).
    """
    spark = tokens.sparkSession
    counts = tokens.groupBy(F.col(token_col).alias("token")).agg(F.count("*").alias("freq"))
    counts = counts.filter(~F.col("token").isin(*SPECIALS))
    ranked = global_rank(counts, [F.desc("freq"), F.col("token")], rank_col="_r")
    body = ranked.select("token", (F.col("_r") + len(SPECIALS)).cast("int").alias("id"), "freq")
    specials = spark.createDataFrame([(t, i) for i, t in enumerate(SPECIALS)], "token string, id int") \
        .withColumn("freq", F.lit(None).cast("long"))
    return specials.unionByName(body)


def lookup_ids(df: DataFrame, key: str, tokens_col: str | dict[str, str], vocab: DataFrame,
               out_col: str = "ids", most: int | None = None,
               most_bytes: int = packed_vocab.LOOKUP_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Token array -> id array, unknown -> ``<unk>`` (0).

    Rows with no tokens get an empty array; rows may repeat a key.  Several
    arrays (``{tokens: ids}``) are looked up at once.  ``most``: for
    encoders that keep at most so many ids, the tokens beyond are not
    looked up.  ``keep``: the columns of ``df`` that are wanted beside the
    ids (all).  Of vocabularies of over ``most_bytes`` the frequent tokens
    are looked up row by row; a row's others are exploded, joined and put in
    their places, with the same result.
    """
    columns = tokens_col if isinstance(tokens_col, dict) else {tokens_col: out_col}
    keep = [c for c in (df.columns if keep is None else keep) if c not in columns.values()]
    kept = [F.coalesce(F.col(c) if most is None else F.slice(c, 1, most), F.array().cast("array<string>")) for c in columns]
    ship_package(df.sparkSession)
    packed = packed_vocab.pack(vocab, most_bytes)
    if packed is not None:
        return df.select(*keep, *[packed_vocab.ids_of(c, packed, UNK).alias(name) for name, c in zip(columns.values(), kept)])
    among = packed_vocab.frequent(most_bytes)
    packed = packed_vocab.pack(vocab.where(among), most_bytes)
    if packed is None:  # ids that repeat
        among = F.lit(False)
        packed = packed_vocab.pack(vocab.where(among), most_bytes)
    ensure_checkpoint_dir(df.sparkSession)
    codes = [f"_c{side}" for side in range(len(columns))]
    coded = df.select(*keep, F.col(key).alias("_key"), *[packed_vocab.coded(c, packed, UNK).alias(x) for x, c in zip(codes, kept)])
    # rows of one key are told apart by their tokens; rows equal in both get
    # the same ids, so their positions may fall together.  Both uses read
    # the written rows, so texts are split and looked up once
    row = coded.withColumn("_row", F.xxhash64("_key", *codes)).checkpoint()
    sides = [F.transform(f"{x}.rare", _placed(side)) for side, x in enumerate(codes)]
    ex = row.select("_key", "_row", F.explode(F.concat(*sides)).alias("_t"))
    v = vocab.where(F.col("token").isNotNull() & ~among).select(F.col("token").alias("_tok"), F.col("id").alias("_vid"))
    hit = ex.join(v, F.col("_t.tok") == F.col("_tok"), "left").select(
        "_key", "_row", "_t.side", F.struct("_t.pos", F.coalesce("_vid", F.lit(UNK)).alias("id")).alias("_p"))
    ids = hit.groupBy(F.col("_key").alias("_k"), F.col("_row").alias("_r")).agg(
        *[F.sort_array(F.collect_set(F.when(F.col("side") == side, F.col("_p")))).alias(f"_f{side}") for side in range(len(codes))])
    out = row.join(ids, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r")), "left")
    whole = [F.when(F.size(f"{x}.rare") == 0, F.col(f"{x}.ids")).otherwise(F.transform(f"{x}.ids", _filled(side)))
             for side, x in enumerate(codes)]
    return out.select(*[F.col(c) for c in keep], *[c.alias(name) for name, c in zip(columns.values(), whole)])


def _placed(side: int):
    return lambda t, i: F.struct(F.lit(side).alias("side"), i.alias("pos"), t.alias("tok"))


def _filled(side: int):
    return lambda x: F.when(x >= 0, x).otherwise(F.get(F.col(f"_f{side}"), -1 - x)["id"])


def wrap_truncate(ids: Column, max_len: int) -> Column:
    """T4 first half: keep ``max_len - 2`` ids, add ``<bos>``/``<eos>``."""
    return F.concat(F.array(F.lit(BOS)), F.slice(ids, 1, max_len - 2), F.array(F.lit(EOS)))


def pad_to(ids: Column, length: Column | int, value: int = PAD) -> Column:
    n = F.lit(length) if isinstance(length, int) else length
    return F.concat(ids, F.array_repeat(F.lit(value), F.greatest(n - F.size(ids), F.lit(0))))


def encode_fixed(ids: Column, max_len: int = 128) -> tuple[Column, Column, Column]:
    """pad/truncate to ``max_len`` with markers; (ids, attention mask, token types)."""
    core = F.concat(F.array(F.lit(BOS)), F.slice(ids, 1, max_len - 2), F.array(F.lit(EOS)))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(core)),
                    F.array_repeat(F.lit(0), F.lit(max_len) - F.size(core)))
    return pad_to(core, max_len), mask, F.array_repeat(F.lit(0), max_len)


def teacher_forcing(ids: Column) -> tuple[Column, Column]:
    """T5: (decoder input = all but last, labels = all but first)."""
    n = F.size(ids) - 1
    return F.slice(ids, 1, n), F.slice(ids, 2, n)


def encode_instruction(df: DataFrame, prompt_ids: str, target_ids: str, max_len: int = 256,
                       pad_id: int = PAD, eos_id: int = EOS) -> DataFrame:
    """Prompt + target (EOS appended), prompt masked in labels, padded.

    Too long: if the overflow is shorter than the target, trim the start
    of the target; otherwise keep the last ``max_len`` positions.
    """
    p, y0 = F.col(prompt_ids), F.col(target_ids)
    y = F.when((F.size(y0) == 0) | (F.element_at(y0, -1) != eos_id),
               F.concat(y0, F.array(F.lit(eos_id)))).otherwise(y0)
    t = df.withColumn("_y", y)
    p, y = F.col(prompt_ids), F.col("_y")
    total = F.size(p) + F.size(y)
    cut = total - max_len
    full_ids, full_lab = F.concat(p, y), F.concat(F.array_repeat(F.lit(IGNORE), F.size(p)), y)
    y_cut = F.slice(y, cut + 1, F.size(y) - cut)
    ids = (F.when(total <= max_len, full_ids)
           .when(cut < F.size(y), F.concat(p, y_cut))
           .otherwise(F.slice(full_ids, -max_len, max_len)))
    lab = (F.when(total <= max_len, full_lab)
           .when(cut < F.size(y), F.concat(F.array_repeat(F.lit(IGNORE), F.size(p)), y_cut))
           .otherwise(F.slice(full_lab, -max_len, max_len)))
    t = t.withColumn("_ids", ids).withColumn("_lab", lab)
    n = F.size("_ids")
    return t.withColumn("input_ids", pad_to(F.col("_ids"), max_len, pad_id)) \
        .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), n),
                                               F.array_repeat(F.lit(0), F.lit(max_len) - n))) \
        .withColumn("labels", pad_to(F.col("_lab"), max_len, IGNORE)) \
        .drop("_y", "_ids", "_lab")


def collator_labels(input_ids: Column, pad_id: int = PAD) -> Column:
    """Labels rebuilt from ids with only pad positions ignored."""
    return F.transform(input_ids, lambda x: F.when(x == pad_id, F.lit(IGNORE)).otherwise(x))


def ignored_to_pad(labels: Column, pad_id: int = PAD) -> Column:
    """Ignored label positions -> pad id before decoding."""
    return F.transform(labels, lambda x: F.when(x == IGNORE, F.lit(pad_id)).otherwise(x))


def cut_at_eos(ids: Column, eos_id: int = EOS) -> Column:
    """Ids before the first ``<eos>`` (all of them if there is none)."""
    p = F.array_position(ids, eos_id)
    return F.when(p > 0, F.slice(ids, 1, (p - 1).cast("int"))).otherwise(ids)


def decode(df: DataFrame, key: str, ids_col: str, vocab: DataFrame, out_col: str = "text",
           skip_special: bool = True) -> DataFrame:
    """Ids -> text: cut at first EOS, look tokens up, drop specials, join by space,
    delete the word-piece marker U+2581."""
    row = df.withColumn("_row", F.xxhash64(key, ids_col))  # rows may repeat a key
    ex = row.select(key, "_row", F.posexplode(cut_at_eos(F.col(ids_col))).alias("_pos", "_vid"))
    if skip_special:
        ex = ex.filter(F.col("_vid") >= len(SPECIALS))
    v = vocab.select(F.col("id").alias("_id"), F.col("token").alias("_tok"))
    tok = ex.join(v, F.col("_vid") == F.col("_id"), "left").select(
        F.col(key).alias("_k"), F.col("_row").alias("_r"), "_pos", F.coalesce("_tok", F.lit(SPECIALS[UNK])).alias("_tok"))
    txt = tok.groupBy("_k", "_r").agg(F.sort_array(F.collect_set(F.struct("_pos", "_tok"))).alias("_p"))
    txt = txt.select("_k", "_r", F.replace(F.array_join(F.transform("_p", lambda s: s["_tok"]), " "),
                                           F.lit("▁"), F.lit("")).alias(out_col))
    out = row.join(txt, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r")), "left")
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(""))).drop("_k", "_r", "_row")


def valid_tokens(labels: Column) -> Column:
    """Number of positions whose label is not ignored."""
    return F.size(F.filter(labels, lambda x: x != IGNORE))
