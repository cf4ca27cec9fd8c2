import random

from sluice.llm import truncation

NOUNS = "window folder ledger catalog manifest partition checkpoint envelope payload record".split()
VERBS = "rejected compared archived validated repaired counted".split()


def sentence(rng):
    return f"The {rng.choice(NOUNS)} {rng.choice(VERBS)} every {rng.choice(NOUNS)} and the {rng.choice(NOUNS)} of run {rng.randrange(100, 999)} was {rng.choice(VERBS)} later."


def corpus(rng, n):
    rows = []
    for k in range(n):
        body = " ".join(sentence(rng) for _ in range(5))
        kind = k % 6
        if kind == 0:
            body += "\nRegards\nops-" + str(rng.randrange(10, 20))
        elif kind == 1:
            body += "".join(f"\n- {rng.choice(NOUNS)}: {rng.choice(['string', 'bigint', 'date'])}" for _ in range(3))
        elif kind == 2:
            body = "\n".join(f"2026-01-01 10:0{i}:00 INFO {sentence(rng)[:-1]} rows={rng.randrange(1000, 9999)}" for i in range(5))
        elif kind == 3:
            body += "\n```\nselect a from b\n```"
        elif kind == 4:
            body += " To be continued…"
        rows.append((k, body, ["mail", "wiki", "log", "wiki", "wiki", "mail"][kind]))
    return rows


def judged(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    p = truncation.profile(df).cache()
    return {r["doc_id"]: r["cause"] for r in truncation.detect(p).collect()}, p


CUT = [
    ("The window rejected every fol", "mail", "word"), ("The window rejected every folder and the", "mail", "sentence"), ("The window rejected every part…", "mail", "word"), ("The window rejected every folder…", "mail", "dots"),
    ("The window was ca�", "mail", "character"), ("Start.\n```\nselect a fr", "wiki", "block"), ("The window rej\n[message clipped]", "mail", "remark"), ("The window rej (cut)", "mail", "remark"),
    ("2026-01-01 10:00:00 INFO The window rejected rows=1234\n2026-01-01 10:01:00 INFO The window rejected every", "log", "sentence"), ("The window was compared later.\n- folder: stri", "wiki", "word"),
]


def test_cut_and_whole(spark):
    rows = corpus(random.Random(1), 600)
    cut = [(1000 + k, t, s) for k, (t, s, _) in enumerate(CUT)]
    odd = [(2000, None, "mail"), (2001, "", "mail"), (2002, "   \n", "mail"), (2003, sentence(random.Random(2)), None)]
    got, p = judged(spark, rows + cut + odd + [cut[0]])
    assert got == {1000 + k: cause for k, (_, _, cause) in enumerate(CUT)}
    rates = {r["source"]: r["truncated"] for r in truncation.rates(p).collect()}
    assert rates["log"] == 1 and rates["mail"] == 8 and rates[""] == 0  # one mail stands there twice


def test_remarks_are_learnt(spark):
    rng = random.Random(6)
    rows = corpus(rng, 300) + [(5000 + k, f"{sentence(rng)} (ref 4{k})", "wiki") for k in range(20)]
    ends = ["every fol", "every folder", "the che", "every window", "the enve", "the"]
    cut = [(6000 + k, f"The window rejected {e}\n[resto omesso]", "mail") for k, e in enumerate(ends)]
    got, _ = judged(spark, rows + cut)
    assert got == {r[0]: "remark" for r in cut}
    assert truncation.bracketed("a b.\n[Rest 12]  ") == ("rest 99", "plain", "b", "b.") and truncation.bracketed("[x]") is None and truncation.bracketed("a (b) c") is None


def test_verdicts_do_not_depend_on_size(spark):
    """Ten times the rows, and ten times the cut ones: cut words that repeat are still cut."""
    small, large = corpus(random.Random(3), 300), corpus(random.Random(3), 3000)
    cut = [(10_000 + k, "The window rejected every fol", "mail") for k in range(3)]
    many = [(20_000 + k, "The window rejected every fol", "mail") for k in range(30)]
    assert set(judged(spark, small + cut)[0]) == {r[0] for r in cut}
    assert set(judged(spark, large + many)[0]) == {r[0] for r in many}


def test_piled_lengths(spark):
    rng = random.Random(4)
    rows = corpus(rng, 600)
    long = [(5000 + k, " ".join(sentence(rng) for _ in range(20))[:400], "mail") for k in range(40)]
    got, _ = judged(spark, rows + long)
    cut = {d for d, t, _ in long if not t.rstrip().endswith(".")}
    assert cut <= set(got) and "limit" in {got[d] for d in cut}


def test_empty(spark):
    assert judged(spark, corpus(random.Random(1), 6)[:0])[0] == {}


def test_trie(spark):
    w = spark.createDataFrame([("ab", 2), ("abc", 3), ("x", 1)], "word string, n bigint")
    assert {r["prefix"]: r["below"] for r in truncation.trie(w).collect()} == {"a": 5, "ab": 3}


def test_trie_of_long_words(spark):
    long = "store/" + "verylongfolder/" * 5 + "part"
    w = spark.createDataFrame([(long, 3), (long[:60], 2)], "word string, n bigint")
    got = {r["prefix"]: r["below"] for r in truncation.trie(w, spark.createDataFrame([(long[:55],), (long[:60],), (long,), ("other" * 20,)], "last string")).collect()}
    assert got[long[:40]] == 5 and got[long[:55]] == 5 and got[long[:60]] == 3 and long not in got and len(got) == 42


def test_cut_in_a_long_word(spark):
    long = "store/" + "verylongfolder/" * 5 + "part"
    rows = [(k, f"* Copied {long} to the lake\n* Moved {long} again", "log") for k in range(20)] + [(99, f"* Copied {long[:55]}", "log")]
    got = truncation.detect(truncation.profile(spark.createDataFrame(rows, "doc_id bigint, text string, source string")))
    assert {(r["doc_id"], r["cause"]) for r in got.collect()} == {(99, "word")}
