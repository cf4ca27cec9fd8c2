"""Mixing sources to target weights by exact token counts: subset-sum budget fitting.

Texts are counted by their exact length in tokens of a public tokenizer. Each source's budget is filled evenly over all lengths but for
a window at its end, which a bounded-knapsack dynamic programme over the counts of texts of each length fills; where it can't fill it
exactly, what was taken evenly is given back, window by window, until no better sum exists. Only then are texts chosen, by a
seeded order inside each length.
"""

from __future__ import annotations

import base64
import importlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Where the vocabulary files of public tokenizers lie, and which of them counts.
TOKENIZERS, RANKS = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
#: How words are split before byte pairs are joined; belongs to the vocabulary. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Tokens of the dynamic programme's first window; it doubles up to LARGEST before other ways are tried.
WINDOW, LARGEST = 1 << 16, 1 << 22


def _encoding(path: str):
    tiktoken = importlib.import_module("tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(documents: DataFrame, keys: list[str], text: str = "text", vocabulary: str = f"{TOKENIZERS}/{RANKS}") -> DataFrame:
    """``keys`` and ``n_tokens bigint`` of the whole text (null: 0), and ``text_key binary``, a digest that is the same for
    the same text. The vocabulary file must be readable on all executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in batches:
            n = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], batch.column(len(keys) + 1), pa.array(n, pa.int64())], [*(f"k{i}" for i in range(len(keys))), "text_key", "n_tokens"])

    x = documents.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias("__t"), F.unhex(F.sha2(F.col(f"`{text}`"), 256)).alias("__h")).toDF(*[f"k{i}" for i in range(len(keys))], "t", "h")
    schema = ", ".join([*(f"k{i} {x.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys))), "text_key binary", "n_tokens bigint"])
    return x.mapInArrow(run, schema).toDF(*keys, "text_key", "n_tokens")


def fit(lengths: np.ndarray, available: np.ndarray, budget: int, window: int = WINDOW, largest: int = LARGEST) -> np.ndarray:
    """How many uses of each length fill the budget exactly or, where no uses do, as far below it as can be.

    lengths: distinct, positive. available: most uses of each. The answer is exact for any budget, in one of these ways:

    All but ``window`` tokens are taken evenly from all lengths and a programme over the window's sums finds the best use of what is
    left. A sum that fills the budget can't be bettered. Otherwise the window doubles, which gives back what was taken, up to ``largest``.
    If no sum has filled the budget by then and a length alone could supply it, the smallest sums of the other lengths by their remainder modulo
    that length decide, whatever the budget (memory: that length). Failing that, the window doubles on until it holds the whole budget
    (memory: 5 bytes a token of it); this takes lengths so few and large that no window of LARGEST tokens can be filled.
    """
    n = len(lengths)
    if not n or budget <= 0:
        return np.zeros(n, np.int64)
    unit = math.gcd(*map(int, lengths))
    lengths, budget = lengths // unit, budget // unit
    total = sum(int(a) * int(b) for a, b in zip(lengths, available))
    if budget >= total:
        return available.copy()
    ample = [i for i in range(n) if int(lengths[i]) * int(available[i]) >= budget]
    while True:
        used, left = _programme(lengths, available, budget, window, total)
        if not left or window >= budget:
            return used
        if window >= largest and ample:
            return _by_remainder(lengths, available, budget, min(ample, key=lambda i: lengths[i]))
        window *= 2


def _parts(count: int) -> list[int]:
    """Amounts of which every number up to count is a sum: powers of two and a rest."""
    out, n = [], 1
    while count > 0:
        out.append(min(n, count))
        count -= out[-1]
        n *= 2
    return out


def _programme(lengths: np.ndarray, available: np.ndarray, budget: int, window: int, total: int) -> tuple[np.ndarray, int]:
    """The best uses with all but ``window`` tokens of the budget taken evenly, and what they leave of it."""
    take = max(0, budget - window)
    used = np.array([int(a) * take // total for a in available], np.int64)
    rest = budget - sum(int(a) * int(b) for a, b in zip(lengths, used))
    # Rounding down may leave more than the window: the longest first, down to its size.
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= window:
            break
        more = min(int(available[i] - used[i]), (rest - window) // int(lengths[i]))
        used[i] += more
        rest -= more * int(lengths[i])
    reach = np.zeros(rest + 1, bool)
    reach[0] = True
    by = np.full(rest + 1, -1, np.int32)
    parts: list[tuple[int, int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        if reach[rest]:
            break
        size = int(lengths[i])
        for k in _parts(min(int(available[i] - used[i]), rest // size)):
            w = k * size
            new = np.flatnonzero(reach[: rest + 1 - w] & ~reach[w:]) + w
            by[new] = len(parts)
            reach[new] = True
            parts.append((int(i), k))
    s = int(np.flatnonzero(reach)[-1])
    left = rest - s
    while s:
        i, k = parts[by[s]]
        used[i] += k
        s -= k * int(lengths[i])
    return used, left


def _by_remainder(lengths: np.ndarray, available: np.ndarray, budget: int, filler: int) -> np.ndarray:
    """The best uses where the length ``filler`` alone could supply the budget: of the other lengths only the smallest sum of each
    remainder matters, as any number of fillers goes on top of it."""
    m = int(lengths[filler])
    far = np.iinfo(np.int64).max // 4
    least = np.full(m, far, np.int64)
    least[0] = 0
    steps: list[tuple[int, int, np.ndarray]] = []
    for i in range(len(lengths)):
        if i == filler:
            continue
        for k in _parts(min(int(available[i]), budget // int(lengths[i]), m)):  # m uses of a length are a multiple of m
            w = k * int(lengths[i])
            moved = np.roll(least, w % m) + w
            better = moved < least
            if better.any():
                least = np.where(better, moved, least)
                steps.append((i, k, np.packbits(better)))
    gap = np.where(least <= budget, (budget - least) % m, far)
    r = int(gap.argmin())
    s = int(least[r])
    used = np.zeros(len(lengths), np.int64)
    used[filler] = (budget - s) // m
    for i, k, better in reversed(steps):
        if np.unpackbits(better, count=m)[r]:
            used[i] += k
            r = (r - k * int(lengths[i])) % m
    return used


def budgets(histogram: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available_tokens, budget) for each target.

    Without ``total_tokens``, the total is that of all texts of the targets that may be used, each text once. It so hangs on
    no single source: one with too little text, or none, falls short of its budget and takes nothing from the others. Null or
    non-positive shares and repeats count as 0. A source named twice counts once: largest share, then largest repeats.
    """
    have = histogram.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("texts")).alias("available_tokens"))
    t = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max(F.struct(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats"))).alias("m"))
    t = t.select("source", "m.*").join(have, "source", "left").withColumn("available_tokens", F.coalesce("available_tokens", F.lit(0)))
    usable = F.when((F.col("target_share") > 0) & (F.col("max_repeats") > 0), F.col("available_tokens"))
    total = F.lit(total_tokens) if total_tokens is not None else F.coalesce(F.sum(usable).over(Window.partitionBy(F.lit(1))), F.lit(0))  # as few rows as targets
    return t.withColumn("budget", F.floor(F.col("target_share") * total + 1e-6).cast("bigint"))


def mix(documents: DataFrame, targets: DataFrame, seed: int = 0, total_tokens: int | None = None, doc_id: str = "doc_id", source: str = "source", text: str = "text", counted: DataFrame | None = None) -> DataFrame:
    """The mix: (doc_id, source, n_tokens, copies), one row for each text used, copies between 1 and its ``max_repeats``.

    Each target source supplies its budget of tokens exactly where its lengths allow, else as near below as they do; a
    source with too little text supplies all of it ``max_repeats`` times. A text under several ids is one text: it is used
    under its smallest id and counts for that id's source. Texts without tokens, without id or source, and of sources
    without target aren't used. The choice depends only on the seed and the rows, not on their order or partitions.

    counted: the result of count_tokens for (doc_id, source), where it is stored already. Lengths and their counts a source,
    not texts, reach a single task; the number of lengths is bounded by the longest text. Budgets are filled as ``fit`` says, whatever their size.
    """
    counted = count_tokens(documents.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")), ["doc_id", "source"]) if counted is None else counted
    texts = counted.where((F.col("n_tokens") > 0) & F.col("doc_id").isNotNull() & F.col("source").isNotNull()).groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("m")).select("m.*")
    histogram = texts.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("texts"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n_tokens")
        repeats = int(pdf["max_repeats"].iloc[0])
        uses = fit(pdf["n_tokens"].to_numpy(np.int64), pdf["texts"].to_numpy(np.int64) * repeats, int(pdf["budget"].iloc[0]))
        return pd.DataFrame({"source": pdf["source"], "n_tokens": pdf["n_tokens"], "uses": uses, "texts": pdf["texts"]})

    solved = histogram.join(budgets(histogram, targets, total_tokens), "source").groupBy("source").applyInPandas(solve, "source string, n_tokens bigint, uses bigint, texts bigint").where("uses > 0")
    # Rank of each text in the seeded order of its length, in two levels, so that no length is sorted in one task.
    h = F.xxhash64(F.lit(seed), F.col("doc_id"))
    x = texts.withColumn("__h", h).withColumn("__bucket", F.shiftrightunsigned(F.col("__h"), 54).cast("int"))
    sizes = x.groupBy("source", "n_tokens", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("source", "n_tokens", "__bucket", (F.sum("__n").over(Window.partitionBy("source", "n_tokens").orderBy("__bucket")) - F.col("__n")).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("source", "n_tokens", "__bucket").orderBy("__h", "doc_id")) + F.col("__before")
    ranked = x.join(solved, ["source", "n_tokens"]).join(before, ["source", "n_tokens", "__bucket"]).withColumn("__rank", rank)
    copies = F.expr("uses div texts") + F.when(F.col("__rank") <= F.col("uses") % F.col("texts"), 1).otherwise(0)
    return ranked.select("doc_id", "source", "n_tokens", copies.cast("bigint").alias("copies")).where("copies > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, texts, tokens, actual_share, most_repeats) of each target; sources without text have 0."""
    got = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_repeats"))
    x = targets.select("source", "target_share").join(got, "source", "left").na.fill(0, ["texts", "tokens", "most_repeats"])
    return x.withColumn("actual_share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy(F.lit(1))), F.lit(0)), F.lit(0.0)))
