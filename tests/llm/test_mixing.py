import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import mixing

pytestmark = pytest.mark.skipif(not __import__("os").path.exists(mixing.TOKENIZERS), reason="no tokenizer files here")


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 25), st.integers(0, 5), min_size=1, max_size=7), st.integers(0, 250))
def test_fit_is_the_best_subset_sum(have, budget):
    lengths, available = np.array(list(have)), np.array(list(have.values()))
    reach = {0}
    for n, a in have.items():
        reach = {r + n * k for r in reach for k in range(a + 1)}
    used = mixing.fit(lengths, available, budget)
    assert (used >= 0).all() and (used <= available).all() and int((used * lengths).sum()) == max(r for r in reach if r <= budget)


def best(have, budget):
    reach = 1  # bit s: the sum s can be reached
    for n, a in have.items():
        k = 1
        while a > 0:
            k = min(k, a)
            reach |= reach << n * k
            a -= k
            k *= 2
    return (reach & ((1 << budget + 1) - 1)).bit_length() - 1


def check(have, budget, **kw):
    lengths, available = np.array(list(have)), np.array(list(have.values()))
    used = mixing.fit(lengths, available, budget, **kw)
    assert (used >= 0).all() and (used <= available).all()
    return int((used * lengths).sum())


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40), min_size=1, max_size=5), st.integers(0, 4000), st.sampled_from([1, 2, 7, 64]), st.sampled_from([1, 8, 1 << 22]))
def test_fit_in_small_windows(have, budget, window, largest):
    assert check(have, budget, window=window, largest=largest) == best(have, budget)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 90_000), st.integers(0, 60), min_size=1, max_size=4), st.integers(65_537, 2_000_000))
def test_fit_beyond_the_first_window(have, budget):
    assert check(have, budget) == best(have, budget)


def test_fit_gives_back():
    assert check({60_000: 4, 90_000: 1}, 240_000) == 240_000
    assert check({3: 10, 7: 10, 50_001: 30}, 1_000_020) == 1_000_020
    big = {50_001: 10**6, 50_003: 10**6}
    assert check(big, 5 * 10**10 + 7, largest=1 << 18) == 5 * 10**10 + 7  # far beyond any window
    few = 9 * 10**12 + 5
    assert check({999_983: 10**7, 1_000_003: 3}, few, largest=1 << 18) == max((few - 1_000_003 * k) // 999_983 * 999_983 + 1_000_003 * k for k in range(4))
    assert check({5: 3}, 0) == 0 and check({5: 0}, 3) == 0 and len(mixing.fit(np.array([], np.int64), np.array([], np.int64), 5)) == 0


def test_counting_needs_no_package_on_workers():
    import subprocess
    import sys

    code = (
        "from pyspark import cloudpickle; import pickle, sys; sys.path.insert(0, %r); import sluice; from sluice.llm import mixing;"
        "sys.stdout.buffer.write(cloudpickle.dumps(mixing._encoding))" % __file__.rsplit("/tests/", 1)[0]
    )
    data = subprocess.run([sys.executable, "-c", code], check=True, capture_output=True).stdout
    run = f"import pickle, sys; f = pickle.loads({data!r}); print(len(f({mixing.TOKENIZERS + '/' + mixing.RANKS!r}).encode_ordinary('two words')), 'sluice' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", run], check=True, capture_output=True, text=True, cwd="/").stdout.split() == ["2", "False"]


def test_fit_large():
    rng = np.random.default_rng(1)
    lengths = np.arange(3, 2500)
    available = rng.integers(0, 500, len(lengths))
    budget = int((lengths * available).sum() * 0.31) + 1
    used = mixing.fit(lengths, available, budget)
    assert int((used * lengths).sum()) == budget and (used <= available).all()


DOCS = [(k, ["wiki", "chat", "tiny"][0 if k % 10 < 6 else 1 if k % 10 < 9 else 2], f"text number {k} " + "word " * (k % 37)) for k in range(1500)] + [(9000, "wiki", None), (9001, "wiki", ""), (9002, None, "no source"), (9003, "other", "no target"), (9004, "chat", DUP := "text number 5 word word word word word")]
TARGETS = [("wiki", 0.5, 1), ("chat", 0.3, 2), ("tiny", 0.15, 3), ("absent", 0.05, 5)]


def frames(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, source string, text string").repartition(5), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")


def test_mix_meets_budgets_and_caps(spark):
    docs, targets = frames(spark)
    mixed = mixing.mix(docs, targets).cache()
    rows = mixed.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and not {9000, 9001, 9002, 9003} & {r["doc_id"] for r in rows}
    cap = {s: m for s, _, m in TARGETS}
    assert all(1 <= r["copies"] <= cap[r["source"]] for r in rows)
    got = {r["source"]: r for r in mixing.shares(mixed, targets).collect()}
    total = sum(r["n_tokens"] * r["copies"] for r in rows)
    for s, share, _ in TARGETS[:3]:
        assert abs(got[s]["actual_share"] - share / 0.95) < 1e-3 and got[s]["tokens"] == sum(r["n_tokens"] * r["copies"] for r in rows if r["source"] == s)
    assert got["absent"]["tokens"] == 0 and abs(sum(r["actual_share"] for r in got.values()) - 1) < 1e-9 and total > 0
    # The same rows in another order and partitioning give the same mix; another seed another.
    again = mixing.mix(docs.orderBy(F.rand()).repartition(2), targets).collect()
    assert sorted(again) == sorted(rows)
    assert sorted(mixing.mix(docs, targets, seed=5).collect()) != sorted(rows)


def test_scarce_source_gives_all_it_has(spark):
    docs, targets = frames(spark)
    rows = [r for r in mixing.mix(docs, targets, total_tokens=10_000_000).collect() if r["source"] == "tiny"]
    assert len(rows) == 150 and all(r["copies"] == 3 for r in rows)


def test_one_poor_source_does_not_shrink_the_mix(spark):
    docs, targets = frames(spark)
    whole = {r["source"]: r["tokens"] for r in mixing.shares(mixing.mix(docs, targets), targets).collect()}
    more = docs.union(spark.createDataFrame([(9100, "absent", "the only text of a poor source")], docs.schema))
    mixed = mixing.mix(more, targets).cache()
    got = {r["source"]: r for r in mixing.shares(mixed, targets).collect()}
    size = mixing.count_tokens(more, ["doc_id", "source"]).where("doc_id = 9100").first()["n_tokens"]
    assert got["absent"]["tokens"] == 5 * size and got["absent"]["actual_share"] < 0.05 and got["absent"]["most_repeats"] == 5
    assert all(0 <= got[s]["tokens"] - whole[s] <= size for s in ("wiki", "chat", "tiny"))


def test_a_text_under_two_ids_is_one_text(spark):
    docs = spark.createDataFrame([(1, "a", "same text"), (2, "a", "same text"), (3, "b", "same text"), (4, "a", "another one")], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 1.0, 2), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    assert {(r["doc_id"], r["copies"]) for r in mixing.mix(docs, targets, total_tokens=10**6).collect()} == {(1, 2), (4, 2)}


def test_token_counts_are_the_tokenizers(spark):
    texts = ["", "Hello world", "ünïcödé  ½ ²", "<|endoftext|>", "a" * 3000, "\n\n  x\t"]
    encoding = mixing._encoding(f"{mixing.TOKENIZERS}/{mixing.RANKS}")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, text string")
    got = {r["i"]: r["n_tokens"] for r in mixing.count_tokens(df, ["i"]).collect()}
    assert got == {i: len(encoding.encode_ordinary(t)) for i, t in enumerate(texts)} | {99: 0}
    import public_tokenizers

    assert mixing.PATTERN == public_tokenizers.PATTERN


def test_empty(spark):
    docs, targets = frames(spark)
    assert mixing.mix(docs.limit(0), targets).count() == 0 == mixing.mix(docs, targets.limit(0)).count()
    assert {r["tokens"] for r in mixing.shares(mixing.mix(docs.limit(0), targets), targets).collect()} == {0}
