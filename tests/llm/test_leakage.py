import random


from sluice.llm import leakage
from sluice.llm.words import words

VOCABULARY = [f"{a}{b}{c}" for a in "bcdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "lk", "m")]


def text(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return {(r["doc_id"], r["item_id"]): r for r in leakage.search(leakage.build_index(d, **kw), i).collect()}


def test_words():
    assert words("The “Quick” brown-ish f­ox, it’s\nre-\n loaded!") == ["the", "quick", "brownish", "fox", "its", "reloaded"]
    assert words("thе nіght ÉTÉ ﬁne") == ["the", "night", "ete", "fine"]
    assert words("The <b>quick</b>&nbsp; **brown** `fox` is <1 & >2") == ["the", "quick", "brown", "fox", "is", "1", "2"]
    assert words("") == [] and words("- — …") == []


def test_passages_of_all_sorts(spark):
    rng = random.Random(1)
    item = text(rng, 60)
    docs, want = [], set()

    def add(passage, hit, join=" "):
        k = len(docs)
        docs.append((k, join.join(text(rng, rng.randrange(0, 40)) + passage + text(rng, rng.randrange(0, 40)))))
        if hit:
            want.add((k, 1))

    for _ in range(6):
        at = rng.randrange(0, 40)
        add(item[at : at + 20], True)
        add(item, True)
        add(item[at : at + 9], False)
        add([w.upper() for w in item[at : at + 20]], True, ",\n ")
        long = item[5:45]
        for p in (6, 15, 24, 33):  # single words replaced or lost
            long = long[:p] + ([rng.choice(VOCABULARY)] if p % 2 else []) + long[p + 1 :]
        add(long, True)
        add([w if k % 3 else rng.choice(VOCABULARY) for k, w in enumerate(item[:40])], False)
    docs += [(900, None), (901, ""), (902, "short")]
    got = found(spark, docs, [(1, " ".join(item)), (2, None), (3, "")])
    assert set(got) == want


def test_template_sentences_are_no_leaks(spark):
    rng = random.Random(2)
    frame = "each {} older than {} hours is {} much later whatever the {} {} reports and then {} for table {}".split()
    fill = lambda: [w if w != "{}" else f"{rng.choice(VOCABULARY)}{rng.randrange(1000)}" for w in frame]
    docs = [(k, " ".join(fill() + text(rng, 10))) for k in range(200)]
    assert found(spark, docs, [(1, " ".join(fill()))]) == {}


def test_a_short_passage_may_leak_often(spark):
    rng = random.Random(5)
    items = [(k, text(rng, 60)) for k in (1, 2, 3)]
    docs, want = [], set()

    def add(item, passage):
        want.add((len(docs), item))
        docs.append((len(docs), " ".join(text(rng, 20) + passage + text(rng, 20))))

    for k in range(9):  # a hot item, another word replaced in each
        add(1, [w if j != 4 + k else f"other{k}" for j, w in enumerate(items[0][1][10:34])])
        add(2, [w if j != 11 else "same" for j, w in enumerate(items[1][1][10:34])])  # near-copies
        add(3, items[2][1][10:34] if k else [w if j != 11 else "one" for j, w in enumerate(items[2][1][10:34])])  # copies and one inexact
    items = [(i, " ".join(w)) for i, w in items]
    for shard_words in (300, 10**9):
        assert set(found(spark, docs, items, shard_words=shard_words)) == want


def test_copies_of_any_number_under_any_shards(spark):
    rng = random.Random(11)
    want, docs, items = set(), [], []
    for item, n in ((1, 1), (2, 4), (3, 10), (4, 1000)):
        w = text(rng, 50)
        items.append((item, " ".join(w)))
        for k in range(n):
            passage = w[12:35] if k % 2 else [x if j != 9 else f"other{k}" for j, x in enumerate(w[12:35])]  # every other one with a word replaced
            want.add((len(docs), item))
            docs.append((len(docs), " ".join(text(rng, 6) + passage + text(rng, 6))))
    for shard_words in (40, 3000, 10**9):
        assert set(found(spark, docs, items, shard_words=shard_words)) == want


def test_the_same_places_with_other_contents_are_no_leaks(spark):
    rng = random.Random(6)
    frame = text(rng, 24)
    docs = [(k, " ".join(text(rng, 10) + [w if j not in (8, 16) else f"other{k}" for j, w in enumerate(frame)] + text(rng, 10))) for k in range(9)]
    for shard_words in (80, 10**9):
        assert found(spark, docs, [(1, " ".join(frame + text(rng, 30)))], shard_words=shard_words) == {}


def test_words_weigh_the_same_in_every_shard(spark):
    rng = random.Random(7)
    item = text(rng, 60)
    passage = [w if j not in (5, 10, 15) else f"other{j}" for j, w in enumerate(item[10:32])]
    # The replaced words are common in the corpus, but not in the document's own shard; the others are rarer.
    docs = [(0, " ".join(text(rng, 5) + passage + text(rng, 5)))] + [(k, " ".join([item[15], item[20], item[25]] * 20)) for k in range(1, 30)]
    shares = [{k: r["share"] for k, r in found(spark, docs, [(1, " ".join(item))], shard_words=n).items()} for n in (30, 300, 10**9)]
    assert set(shares[0]) == {(0, 1)} and shares[0] == shares[1] == shares[2]


def test_against_brute_force_over_shards(spark):
    rng = random.Random(3)
    items = [(k, " ".join(text(rng, rng.randrange(25, 90)))) for k in range(12)]
    docs = []
    for k in range(120):
        own = text(rng, rng.randrange(0, 200))
        if rng.random() < 0.4:
            w = items[rng.randrange(12)][1].split()
            n = rng.choice([8, 12, 20, 25])
            at = rng.randrange(0, len(w) - n + 1) if n <= len(w) else 0
            own[len(own) // 2 : len(own) // 2] = w[at : at + n]
        docs.append((k, " ".join(own)))

    def longest(a, b):
        best, row = 0, [0] * (len(b) + 1)
        for x in a:
            row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
            best = max(best, *row)
        return best

    want = {(d, i) for d, t in docs for i, u in items if longest(u.split(), t.split()) >= 20}
    for shard_words in (500, 10**9):
        got = found(spark, docs, items, shard_words=shard_words)
        assert want <= set(got) and all(r["words"] >= 20 for r in got.values())
        assert len(set(got) - want) <= 1


def test_short_items_repeats_and_blocks(spark, monkeypatch):
    docs = [(1, "one two three four five"), (1, "one two three four five"), (2, "one two three four six"), (3, "nothing here")]
    items = [(7, "two three four five"), (8, "two three four five")]
    assert set(found(spark, docs, items)) == {(1, 7), (1, 8)}
    monkeypatch.setattr(leakage, "BLOCK_WORDS", 3)
    assert set(found(spark, docs, items)) == {(1, 7), (1, 8)}
    monkeypatch.setattr(leakage, "BLOCKS", 1)
    assert set(found(spark, docs, [*items, (9, "three four six"), (None, "two three four five"), (10, "")])) == {(1, 7), (1, 8), (2, 9)}
    df = spark.createDataFrame([(i, t) for i, t in items], "i bigint, t string")
    assert [len(b) for b in leakage._blocks(df)] == [1, 1]
    assert found(spark, docs, []) == {} and found(spark, [], items) == {}


def test_phrases(spark):
    rng = random.Random(4)
    docs = [(k, " ".join(rng.choice("abc") for _ in range(200))) for k in range(30)]
    index = leakage.build_index(spark.createDataFrame(docs, "doc_id bigint, text string"), shard_words=900)
    for phrase in ("a b c a", "c c", "a", "a d"):
        p = phrase.split()
        want = sorted((k, i) for k, t in docs for i in range(200) if t.split()[i : i + len(p)] == p)
        assert sorted((r["doc_id"], r["place"]) for r in leakage.phrases(index, phrase).collect()) == want
