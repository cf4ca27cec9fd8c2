"""Evaluation texts leaking into training text: a distributed positional inverted index.

The index is sharded by document: each shard row holds the term dictionary, the token postings of every term (places in
the shard's running word count, in order) and where its documents begin. Shards are written where their documents were
read, so building the index shuffles nothing, and any number of test sets can be searched without reading texts again.

A search takes windows of words from each test item, starts from the postings of a window's rarest terms, intersects them
with the offset-adjusted postings of the other terms (exactly, or within a few places for proximity), and aligns
what is left word by word. Test items go to all shards in blocks of bounded size. How common the items' words and phrases are
is counted over all shards first, so no verdict hangs on the shard in which a document stands.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from difflib import SequenceMatcher
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.words import words
from sluice.session import fresh

INDEX = "doc_ids array<bigint>, doc_starts array<int>, terms array<string>, term_starts array<int>, postings binary"
#: Words of a shard. A document is never split; one that is longer makes a shard of its own.
SHARD_WORDS = 400_000
#: Words of test items in a block, and blocks that go to the executors at once.
BLOCK_WORDS, BLOCKS = 200_000, 4
#: Words of a block, of which the rarest is looked up; words around it that are compared; places they may be off; band of the alignment.
BLOCK, DRIFT, BAND = 6, 2, 12
#: Part of the weight of 20 words that must stand near its places for an alignment; a passage that counts has 0.7 of it in order.
NEAR = 0.6
#: Words of a run; documents a SHARD_WORDS of the index, and three at least, in which a passage's own run may stand without the passage.
RUN, OWN = 4, 3
#: What search() knows of a passage before runs are compared over all shards. runs: of an inexact short passage, with the documents
#: that have them. places, filler: the item's words that it lacks and what stands there instead. carried: the item's runs in the document.
HITS = "doc_id bigint, item_id bigint, words int, matched int, share float, first_word int, runs array<struct<run:int,docs:bigint>>, places string, filler string, carried array<int>"


def _shard(ids: list[int], sizes: list[int], tokens: list[str]) -> list:
    term_of: dict[str, int] = {}
    codes = np.fromiter((term_of.setdefault(t, len(term_of)) for t in tokens), np.int32, len(tokens))
    order = np.argsort(codes, kind="stable").astype(np.int32)
    starts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(term_of)))])
    return [ids, np.concatenate([[0], np.cumsum(sizes)]), list(term_of), starts, order.tobytes()]


def build_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row a shard; see INDEX. Every token of every text is posted, however common. Null and empty texts have no words,
    texts of any length are indexed whole, repeated texts are indexed under each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        sizes: list[int] = []
        tokens: list[str] = []

        def flush() -> pa.RecordBatch:
            cells = _shard(list(ids), sizes, tokens)
            types = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary()]
            ids.clear(), sizes.clear(), tokens.clear()
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], ["doc_ids", "doc_starts", "terms", "term_starts", "postings"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = t.as_py()
                if i is None or not t:
                    continue
                w = words(t)
                if tokens and len(tokens) + len(w) > shard_words:
                    yield flush()
                ids.append(i), sizes.append(len(w))
                tokens.extend(w)
        if ids:
            yield flush()

    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, INDEX)


class _Block:
    """Test items sent at once: their words in a row, their distinct terms, and their distinct runs of RUN words, numbered."""

    def __init__(self, items: list[tuple[int, list[str]]]) -> None:
        self.ids = np.array([i for i, _ in items], np.int64)
        self.length = np.array([len(w) for _, w in items], np.int64)
        self.first_of = np.cumsum(self.length) - self.length
        self.everything = [w for _, ws in items for w in ws]
        self.item_of = np.repeat(np.arange(len(self.ids)), self.length)
        self.terms: dict[str, int] = {}
        self.term_of = np.fromiter((self.terms.setdefault(w, len(self.terms)) for w in self.everything), np.int64, len(self.everything))
        self.pairs = pd.Index(np.unique(self.term_of[:-1] * len(self.terms) + self.term_of[1:]))  # hashed, as whole shards are looked up
        four = self._fours(self.term_of)
        self.runs = pd.Index(np.unique(four[self.item_of[: len(four)] == self.item_of[len(self.item_of) - len(four) :]]))
        self.run_of = self.run_at(self.term_of)

    def _fours(self, terms: np.ndarray) -> np.ndarray:
        out = np.full(max(0, len(terms) - RUN + 1), -1, np.int64)
        known = np.flatnonzero((terms[:-1] >= 0) & (terms[1:] >= 0)) if len(out) else out
        two = np.full(len(terms), -1, np.int64)
        two[known] = self.pairs.get_indexer(terms[known] * len(self.terms) + terms[known + 1])
        both = np.flatnonzero((two[: len(out)] >= 0) & (two[2 : len(out) + 2] >= 0))
        out[both] = two[both] * len(self.pairs) + two[both + 2]
        return out

    def run_at(self, terms: np.ndarray) -> np.ndarray:
        """The run that begins at each place of a row of terms, -1 where none of the items' does."""
        four = self._fours(terms)
        known = np.flatnonzero(four >= 0)
        four[known] = self.runs.get_indexer(four[known])
        return four


class _Shard:
    def __init__(self, row: dict) -> None:
        self.doc_ids, self.doc_starts = np.asarray(row["doc_ids"], np.int64), np.asarray(row["doc_starts"], np.int64)
        self.starts, self.postings = np.asarray(row["term_starts"], np.int64), np.frombuffer(row["postings"], np.int32)
        self.terms = {t: i for i, t in enumerate(row["terms"])}
        self.size = len(self.postings)
        # The postings turned round: the term at each place, so that membership in an offset-adjusted list is one look.
        self.at = np.full(self.size + 2 * (BAND + 24), -1, np.int32)
        self.pad = BAND + 24
        self.at[self.pad + self.postings] = np.repeat(np.arange(len(self.starts) - 1, dtype=np.int32), np.diff(self.starts))
        self.count = np.diff(self.starts)

    def codes(self, ws: Collection[str]) -> np.ndarray:
        return np.fromiter((self.terms.get(w, -2) for w in ws), np.int32, len(ws))

    def phrase(self, codes: np.ndarray) -> np.ndarray:
        """Places where the words stand in a row, from the rarest term's list."""
        if not len(codes) or (codes < 0).any():
            return np.zeros(0, np.int64)
        order = np.argsort(self.count[codes], kind="stable")
        r = order[0]
        p = self.postings[self.starts[codes[r]] : self.starts[codes[r] + 1]].astype(np.int64) - r
        p = p[(p >= 0) & (p + len(codes) <= self.size)]
        for k in order[1:]:
            p = p[self.at[self.pad + p + k] == codes[k]]
        doc = np.searchsorted(self.doc_starts, p, "right")
        return p[p + len(codes) <= self.doc_starts[np.minimum(doc, len(self.doc_starts) - 1)]]


def _near(s: _Shard, flat: np.ndarray, word: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether the items' words (indices into flat, inside first..last) stand within DRIFT of their places."""
    code = flat.take(word, mode="clip")
    code = np.where((word >= first) & (word < last), code, -2)
    place = place + s.pad
    found = s.at.take(place) == code
    for d in range(1, DRIFT + 1):
        found |= s.at.take(place + d) == code
        found |= s.at.take(place - d) == code
    return found


def _candidates(s: _Shard, flat: np.ndarray, weight: np.ndarray, item_of: np.ndarray, first_of: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(document, item, diagonal) where an alignment is worth while.

    Each block of an item gives the postings of its rarest term. What is left of a place goes on only if a neighbouring
    word stands next to it, then if half the words around it stand near their places, then if of some 20 words in
    a row 12 do, with the NEAR part of their weight.
    """
    freq = np.where(flat >= 0, s.count[np.maximum(flat, 0)], np.iinfo(np.int64).max)
    anchors = []
    for f, m in zip(first_of, length):
        for lo in range(f, f + m, BLOCK):
            k = lo + int(freq[lo : min(lo + BLOCK, f + m)].argmin())
            if freq[k] < np.iinfo(np.int64).max:
                anchors.append(k)
    found = []
    anchor = np.array(anchors, np.int64)
    upto = np.cumsum(freq[anchor]) if len(anchor) else np.zeros(0, np.int64)
    lo = 0
    while lo < len(anchor):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + 500_000, "right")))
        a = anchor[lo:hi]
        lo = hi
        cnt = freq[a]
        rep = np.repeat(np.arange(len(a)), cnt)
        place = s.postings[np.repeat(s.starts[flat[a]] - (np.cumsum(cnt) - cnt), cnt) + np.arange(len(rep))]
        before, after = flat[np.maximum(a - 1, 0)], flat[np.minimum(a + 1, len(flat) - 1)]
        ok = np.flatnonzero((s.at[place + (s.pad - 1)] == before[rep]) | (s.at[place + (s.pad + 1)] == after[rep]))
        rep, place = a[rep[ok]], place[ok].astype(np.int64)
        # On its own diagonal first, which is cheap, then within the drift.
        hits = np.ones(len(rep), np.int32)
        for k in (-3, -2, -1, 1, 2, 3):
            hits += flat.take(rep + k, mode="clip") == s.at.take(place + (s.pad + k))
        keep = hits >= np.minimum(3, length[item_of[rep]])
        rep, place = rep[keep], place[keep]
        if len(rep):
            item = item_of[rep]
            hits = np.zeros(len(rep), np.int32)
            for k in range(-4, 5):
                hits += _near(s, flat, rep + k, place + k, first_of[item], first_of[item] + length[item])
            keep = hits >= np.minimum(5, length[item])
            rep, place = rep[keep], place[keep]
        if len(rep):
            found.append(np.stack([rep, place], axis=1))
    if not found:
        return np.zeros((0, 3), np.int64)
    c = np.concatenate(found)
    item = item_of[c[:, 0]]
    doc = np.searchsorted(s.doc_starts, c[:, 1], "right") - 1
    base = c[:, 1] - (c[:, 0] - first_of[item])
    _, one = np.unique(np.stack([doc, item, base // 3, (c[:, 0] - first_of[item]) // 12], axis=1), axis=0, return_index=True)
    c, item, doc, base = c[one], item[one], doc[one], base[one]
    good = np.zeros(len(c), bool)
    for lo in range(0, len(c), 4096):
        k = slice(lo, lo + 4096)
        off = np.arange(-20, 21)
        first, last = first_of[item[k]][:, None], (first_of[item[k]] + length[item[k]])[:, None]
        word = c[k, 0][:, None] + off
        near = _near(s, flat, word, c[k, 1][:, None] + off, first, last)
        rare = np.where((word >= first) & (word < last), weight.take(word, mode="clip"), 0)
        in_20 = lambda x: (y := np.cumsum(np.concatenate([np.zeros((len(x), 1), x.dtype), x], axis=1), axis=1))[:, 20:] - y[:, :-20]
        enough = in_20(near.astype(np.int32)) >= np.minimum(12, np.ceil(0.6 * length[item[k]]))[:, None]
        good[k] = (enough & (in_20(near * rare) >= NEAR * in_20(rare))).any(axis=1)
    return np.unique(np.stack([doc[good], item[good], base[good]], axis=1), axis=0)


def _carried(s: _Shard, block: _Block, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, run): each run of the items' words that stands in a document (of those in ``only``, sorted), once, in order."""
    term_of = np.fromiter((block.terms.get(t, -1) for t in s.terms), np.int64, len(s.terms))
    if only is None:
        where = np.arange(s.size)
    else:
        size = s.doc_starts[only + 1] - s.doc_starts[only]
        where = np.repeat(s.doc_starts[only] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    run = block.run_at(term_of[s.at[s.pad + where]]) if len(where) else np.zeros(0, np.int64)
    found = np.flatnonzero(run >= 0)
    place, run = where[found], run[found]
    doc = np.searchsorted(s.doc_starts, place, "right") - 1
    inside = place + RUN <= s.doc_starts[doc + 1]
    return np.divmod(np.unique(doc[inside] * max(1, len(block.runs)) + run[inside]), max(1, len(block.runs)))


def _times(s: _Shard, block: _Block) -> np.ndarray:
    """How often each term of the items stands in the shard."""
    codes = s.codes(block.terms)
    return np.where(codes >= 0, s.count[np.maximum(codes, 0)], 0) if len(s.count) else np.zeros(len(codes), np.int64)


def _own_runs(s: _Shard, codes: np.ndarray, lo: int, hi: int, base: int) -> list[int]:
    """Which of a passage's runs stand exactly, near their place in the document ``lo..hi``."""
    own = []
    for i in range(len(codes) - RUN + 1):
        p = s.phrase(codes[i : i + RUN])
        near = p[(p >= lo) & (p < hi)]
        if len(near) and np.abs(near - (base + i)).min() <= BAND:
            own.append(i)
    return own


def _replaced(s: _Shard, terms: list[str], codes: np.ndarray, lo: int, hi: int, base: int) -> tuple[list[int], str]:
    """Which of a passage's words the document ``lo..hi`` lacks, and the words that stand between those it has."""
    there = s.at[s.pad + max(lo, base - BAND) : s.pad + min(hi, base + len(codes) + BAND)]
    same = SequenceMatcher(None, there.tolist(), codes.tolist(), autojunk=False).get_matching_blocks()[:-1]
    has = {m.b + k for m in same for k in range(m.size)}
    between = [terms[c] for a, b in zip(same, same[1:]) for c in there[a.a + a.size : b.a]]
    return [i for i in range(len(codes)) if i not in has], " ".join(between)


def align(item: np.ndarray, weight: np.ndarray, at: np.ndarray, base: np.ndarray, lo: np.ndarray, hi: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of items (rows, padded with -3) with the words around places ``base + row position``, in a band.

    A match counts 1; a word replaced, lost or put in costs 1, directly after another such edit 2; an alignment that falls
    5 below its best ends. Returns words of the item covered, words matched, the share of the covered words' weight that
    matched, and the first word's position.
    """
    n, width = item.shape
    lanes = np.arange(2 * BAND + 1) - BAND
    neg = np.float32(-1e6)
    zeros = lambda t=np.int32: np.zeros((n, len(lanes)), t)
    score, top, start, hit, gap, got = zeros(np.float32), zeros(np.float32), zeros(), zeros(), zeros(bool), zeros(np.float32)
    best = np.zeros((3, n), np.int64)
    best_got = np.zeros(n, np.float32)
    upto = np.concatenate([np.zeros((n, 1), np.float32), np.cumsum(weight, axis=1)], axis=1)
    best_score = np.zeros(n, np.float32)
    for i in range(width):
        place = base[:, None] + i + lanes
        doc = at[np.clip(pad + place, 0, len(at) - 1)]
        doc = np.where((place >= lo[:, None]) & (place < hi[:, None]), doc, -1)
        same = (doc == item[:, i][:, None]) & (item[:, i][:, None] >= 0)
        fresh = score <= 0
        cost = np.where(gap, 2, 1).astype(np.float32)
        # From the same diagonal: a match, or a word replaced.
        s0 = np.where(same, np.where(fresh, 1, score + 1), score - cost)
        st, h, t = np.where(fresh, i, start), np.where(fresh, 0, hit) + same, np.where(fresh, 0, top)
        w = np.where(fresh, 0, got) + same * weight[:, i][:, None]
        g = ~same
        # A word lost: the diagonal to the right, one item word before.
        s1 = np.full_like(score, neg)
        s1[:, :-1] = (score - cost)[:, 1:]
        use = s1 > s0
        s0 = np.where(use, s1, s0)
        for arr, src in ((st, start), (h, hit), (t, top), (w, got)):
            arr[:, :-1][use[:, :-1]] = src[:, 1:][use[:, :-1]]
        g = g | use
        # A word put in: the diagonal to the left, same item word; twice for two words in a row.
        for _ in range(2):
            s2 = np.full_like(score, neg)
            s2[:, 1:] = s0[:, :-1] - np.where(g[:, :-1], 2, 1)
            use = s2 > s0
            if not use.any():
                break
            s0 = np.where(use, s2, s0)
            for arr in (st, h, t, w):
                arr[:, 1:][use[:, 1:]] = arr[:, :-1].copy()[use[:, 1:]]
            g = g | use
        t = np.maximum(t, s0)
        dead = (s0 <= 0) | (t - s0 >= 5)
        score, top, start, hit, gap, got = np.where(dead, 0, s0), np.where(dead, 0, t), st, np.where(dead, 0, h), g & ~dead, np.where(dead, 0, w)
        lead = np.where(same & ~dead, score, neg)
        k = lead.argmax(axis=1)
        rows = np.arange(n)
        better = lead[rows, k] > best_score
        r, kk = rows[better], k[better]
        best_score[r] = lead[r, kk]
        best[0, r], best[1, r], best[2, r] = i - start[r, kk] + 1, hit[r, kk], start[r, kk]
        best_got[r] = got[r, kk] / np.maximum(1e-6, upto[r, i + 1] - upto[r, start[r, kk]])
    return best[0], best[1], best_got, best[2]


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, list[str]]]]:
    """The items with their words, by id, in blocks of BLOCK_WORDS words (more only where one item has more). Streamed: the driver holds
    what is being sent, never all items."""
    block: list[tuple[int, list[str]]] = []
    size = 0
    for row in items.where("i is not null and t <> ''").orderBy("i").toLocalIterator():
        w = words(row["t"])
        if not w:
            continue
        if block and size + len(w) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row["i"], w))
        size += len(w)
    if block:
        yield block


def _sent(items: DataFrame) -> Iterator[list]:
    """Blocks, some at a time, as many as one pass over the index searches."""
    blocks = _blocks(items)
    while some := list(islice(blocks, BLOCKS)):
        yield some


def _count(index: DataFrame, sent: list) -> tuple[list[dict[int, int]], int]:
    """For each block how many documents of the index have each run (from 0 up) and how often each term stands there (from -2 down); and
    the words of the index. As much as a block's words, whatever the index."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [_Block(b.value) for b in sent]
        terms, docs, size = [np.zeros(len(b.terms), np.int64) for b in blocks], [np.zeros(len(b.runs), np.int64) for b in blocks], 0
        for batch in batches:
            for row in batch.to_pylist():
                s = _Shard(row)
                size += s.size
                for i, block in enumerate(blocks):
                    docs[i] += np.bincount(_carried(s, block)[1], minlength=len(docs[i]))
                    terms[i] += _times(s, block)
        for i in range(len(blocks)):
            k, t = np.flatnonzero(docs[i]), np.flatnonzero(terms[i])
            n = np.concatenate([docs[i][k], terms[i][t], [size]])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), i, np.int32)), pa.array(np.concatenate([k, -2 - t, [-1]])), pa.array(n)], ["block", "k", "n"])

    counts: list[dict[int, int]] = [{} for _ in sent]
    for r in index.mapInArrow(count, "block int, k bigint, n bigint").groupBy("block", "k").agg(F.sum("n").alias("n")).collect():
        counts[r["block"]][r["k"]] = r["n"]
    return counts, counts[0].get(-1, 0)


def _passages(s: _Shard, row_terms: list[str], block: _Block, times: dict[int, int], weight: np.ndarray, min_words: int, min_share: float) -> pd.DataFrame | None:
    """The passages of a block's items in a shard's documents; see HITS."""
    ids, length, first_of, item_of = block.ids, block.length, block.first_of, block.item_of
    flat = s.codes(block.terms)[block.term_of]
    c = _candidates(s, flat, weight, item_of, first_of, length) if s.size else np.zeros((0, 3), np.int64)
    if not len(c):
        return None
    # Diagonals closer than half the band share an alignment.
    new = np.ones(len(c), bool)
    new[1:] = (c[1:, :2] != c[:-1, :2]).any(axis=1) | (c[1:, 2] - c[:-1, 2] > BAND // 3)
    doc, item, base = c[new].T
    rows = []
    for lo in range(0, len(doc), 1024):
        k = slice(lo, lo + 1024)
        col = np.arange(int(length[item[k]].max()))
        at = np.minimum(first_of[item[k]][:, None] + col, len(flat) - 1)
        inside = col < length[item[k]][:, None]
        cov, hit, share, begin = align(np.where(inside, flat[at], -3), np.where(inside, weight[at], 0), s.at, base[k], s.doc_starts[doc[k]], s.doc_starts[doc[k] + 1], s.pad)
        need = np.minimum(min_words, length[item[k]])
        ok = (cov >= need) & (share >= min_share) & (cov * (3 * share - 2) >= 0.55 * need)
        unsure = ok & (share < 0.999) & (cov < 1.5 * need)
        for x in np.flatnonzero(ok):
            d, i = doc[k][x], item[k][x]
            found = {"doc_id": s.doc_ids[d], "item_id": ids[i], "words": cov[x], "matched": hit[x], "share": share[x], "first_word": begin[x], "runs": None, "places": None, "filler": None, "pair": (d, i)}
            if unsure[x]:
                first = first_of[i] + begin[x]
                place = (flat[first:][: cov[x]], s.doc_starts[d], s.doc_starts[d + 1], base[k][x] + begin[x])
                runs = [int(block.run_of[first + j]) for j in _own_runs(s, *place)]
                lacks, filler = _replaced(s, row_terms, *place)
                found |= {"runs": [{"run": r, "docs": times[r]} for r in dict.fromkeys(runs)], "places": " ".join(str(begin[x] + j) for j in lacks), "filler": filler}
            rows.append(found)
    if not rows:
        return None
    hits = pd.DataFrame(rows).sort_values(["words", "matched"], ascending=False, kind="stable")
    # Of passages that are sure, the longest of a pair is enough; the runs in its document count once a pair.
    hits = hits[hits["runs"].notna() | ~hits.assign(sure=hits["runs"].isna()).duplicated(["pair", "sure"])]
    docs, run_in = _carried(s, block, np.unique([d for d, _ in hits["pair"]]))
    carried = []
    for (d, i), seen in zip(hits["pair"], hits.duplicated(["pair"]).to_numpy()):
        own = block.run_of[first_of[i] : max(first_of[i], first_of[i] + length[i] - RUN + 1)]
        carried.append([] if seen else np.intersect1d(run_in[np.searchsorted(docs, d) : np.searchsorted(docs, d, "right")], own).tolist())
    return hits.drop(columns="pair").assign(carried=carried)


def _look(index: DataFrame, sent: list, counted: list, min_words: int, min_share: float) -> DataFrame:
    """The passages of all blocks sent, in one pass over the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = pa.list_(pa.struct([("run", pa.int32()), ("docs", pa.int64())]))
        types = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("words", pa.int32()), ("matched", pa.int32()), ("share", pa.float32()), ("first_word", pa.int32()), ("runs", runs), ("places", pa.string()), ("filler", pa.string()), ("carried", pa.list_(pa.int32()))])
        blocks = []
        for b, c in zip(sent, counted):
            block, n = _Block(b.value), c.value
            times = np.array([n.get(-2 - t, 0) for t in range(len(block.terms))], np.int64)
            blocks.append((block, n, np.log((n.get(-1, 0) + 1) / (1 + times[block.term_of])).astype(np.float32)))
        for batch in batches:
            for row in batch.to_pylist():
                s = _Shard(row)
                for block, n, weight in blocks:
                    hits = _passages(s, row["terms"], block, n, weight, min_words, min_share)
                    if hits is not None:
                        yield pa.RecordBatch.from_pandas(hits, types, preserve_index=False)

    return index.mapInArrow(run, HITS)


def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", min_words: int = 20, min_share: float = 0.7) -> DataFrame:
    """(doc_id, item_id, words, matched, share, first_word): documents that carry ``min_words`` or more successive words of an
    item, the longest such passage of each pair.

    share is how much of the passage stands there unchanged and in order, with each word weighing the logarithm of its
    rarity in the whole index: sentences alike in all but their rare words don't reach it. It must be ``min_share``, and more in short passages:
    words * (3 * share - 2) must reach 0.55 * ``min_words``, which lets one word in seven of the shortest be replaced or lost.
    A passage of less than 1.5 * ``min_words`` with a word replaced or lost must also have three runs of four words of its own:
    sentences made of the same set phrases with other contents haven't. A run is a set phrase if, over the whole index, it stands in
    more than OWN documents a SHARD_WORDS (and more than OWN) that don't carry the item. Documents that carry it never count, however
    many they are, but for those in which the very same two or more places hold other words: contents, not words replaced.

    ``items`` is a held-out test set of any size; it passes through the driver in blocks of at most BLOCK_WORDS words, of which BLOCKS at a time
    are broadcast and searched in all shards, in two passes over the index (counts, then passages). The search is done when this returns; the
    index may then be deleted. Items shorter than ``min_words`` words must stand there whole. Null and empty texts leak
    nowhere; items with the same text are found each under its own id; extra columns don't matter.
    """
    spark = index.sparkSession
    path, size = fresh(spark, "p7-hits"), 0
    spark.createDataFrame([], HITS).write.parquet(path)
    for some in _sent(items.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t"))):
        sent = [spark.sparkContext.broadcast(b) for b in some]
        counts, size = _count(index, sent)
        counted = [spark.sparkContext.broadcast(c) for c in counts]
        _look(index, sent, counted, min_words, min_share).write.mode("append").parquet(path)
        for b in (*sent, *counted):
            b.destroy()
    hits = spark.read.schema(spark.createDataFrame([], HITS).schema).parquet(path)
    cols = ["doc_id", "item_id", "words", "matched", "share", "first_word"]
    unsure = hits.where(F.col("runs").isNotNull()).withColumn("__row", F.monotonically_increasing_id())
    rivals = unsure.groupBy("item_id", "places").agg(F.when(F.col("places").contains(" "), F.count_distinct("filler") - 1).otherwise(0).alias("rivals"))
    having = hits.select("item_id", F.explode("carried").alias("run")).groupBy("item_id", "run").agg(F.count(F.lit(1)).alias("having"))
    x = unsure.select("__row", *cols, "places", F.explode("runs").alias("r")).select("*", "r.run", "r.docs").join(rivals, ["item_id", "places"]).join(having, ["item_id", "run"], "left")
    apart = F.col("docs") - F.coalesce("having", F.lit(0)) + F.col("rivals")
    own = x.groupBy("__row", *cols).agg(F.count_if(apart <= max(OWN, OWN * size / SHARD_WORDS)).alias("own")).where("own >= 3")
    found = hits.where(F.col("runs").isNull()).select(cols).unionByName(own.select(cols))
    # A document id may stand in several rows of the input, and so in several shards.
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("words", "matched", (-F.col("first_word")).alias("f"), "share")).alias("m")).select("doc_id", "item_id", "m.words", "m.matched", "m.share", (-F.col("m.f")).alias("first_word"))


def phrases(index: DataFrame, phrase: str) -> DataFrame:
    """(doc_id, place): where a phrase stands exactly, word for word, by list intersection."""
    ws = words(phrase)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = _Shard(row)
                p = s.phrase(s.codes(ws))
                doc = np.searchsorted(s.doc_starts, p, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(s.doc_ids[doc]), pa.array((p - s.doc_starts[doc]).astype(np.int32))], ["doc_id", "place"])

    return index.mapInArrow(run, "doc_id bigint, place int")
