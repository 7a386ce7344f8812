"""The steps of n-gram counting, in this process, against plain Python: blocks, pages whose rows are apart, packed counts."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from folioframe.plans import grams

ALL = grams.Filter(9, np.full(64, 255, np.uint8))


@pytest.mark.parametrize("sparse", [1 << 22, 40])
def test_packed_counts(monkeypatch, sparse):
    """Few bytes an n-gram, and every hash that comes often enough is found, whether addresses are held or counted."""
    monkeypatch.setattr(grams, "SPARSE", sparse)
    monkeypatch.setattr(grams, "ADDRESS", 30)
    h = np.random.default_rng(1).integers(0, 2**64, 400_000, np.uint64)
    parts = [grams._packed([h[:250_000]]), grams._packed([h[200_000:], h[:1000]])]
    assert sum(len(x.as_py()) for p in parts for x in p.column(1)) <= 6 * 451_000
    rows = sorted(((r["slice"], r["packed"]) for p in parts for r in p.to_pylist() if r["slice"] < 40), key=lambda r: r[0])
    batch = pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], names=["slice", "packed"])
    got = {(r["slice"] << 20) + int(low) for b in grams._merging(2)(iter([batch])) for r in b.to_pylist() for low in np.frombuffer(r["low"], np.uint32)}
    times = Counter((np.r_[h[:250_000], h[200_000:], h[:1000]] >> np.uint64(34)).tolist())
    assert got == {a for a, c in times.items() if c >= 2 and a >> 20 < 40}


@pytest.mark.parametrize("dealt", [False, True])
def test_blocks(monkeypatch, dealt):
    """A row a block and phrase; pages are counted once though their rows are split over batches, blocks and tasks."""
    monkeypatch.setattr(grams, "HELD", 60)
    r = random.Random(3)
    rows = [(p if p % 9 else None, i, [r.choice("A a b c d e".split()) for _ in range(r.randrange(1, 9))]) for p in range(40) for i in range(r.randrange(1, 60 if p == 5 else 6))]
    rows += [(7, i, ["a", "b"]) for i in range(90, 93)]  # again, far from the first
    if dealt:
        r.shuffle(rows)
    number = {w: x - 2**62 for x, w in enumerate("a b c d e".split(), 1)}
    tasks = [rows[:70], rows[70:]]

    def batches(task):
        for i in range(0, len(task), 7):
            p, pos, s = zip(*task[i : i + 7], strict=True)
            t = [[w.lower() for w in x] for x in s]
            cols = [pa.array(p, pa.int64()), pa.array(pos, pa.int32()), pa.array(t), pa.array([[w != "e" for w in x] for x in t]), pa.array([[number[w] for w in x] for x in t]), pa.array([hash(("p", x)) for x in p]), pa.array(s)]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "pos", "tokens", "good", "hashes", "page_hash", "surfaces"])

    runs = Counter(h for task in tasks for b in grams._runs(pa.RecordBatch.from_arrays([b.column(5), b.column(4).value_lengths().cast(pa.int32())], names=["h", "n"]) for b in batches(task)) for h in b.column(0).to_pylist())

    class Apart:
        hashes = np.array([h for h, c in runs.items() if c > 1]).view(np.uint64)

        def __call__(self, h):
            return np.isin(h, self.hashes)

    assert dealt or 0 < len(Apart.hashes) < 8
    out = [x for task in tasks for b in grams._writing({2: ALL, 3: ALL}, Apart(), True)(batches(task)) for x in b.to_pylist()]
    count, pages, first = Counter(), defaultdict(set), {}
    for p, pos, s in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        for n in (2, 3):
            for i in range(len(s) - n + 1):
                g = " ".join(s[i : i + n])
                if "e" not in (g.split()[0], g.split()[-1]):
                    count[g.lower()] += 1
                    pages[g.lower()].add(p)
                    first.setdefault(g.lower(), (p is not None, p or 0, pos, i))
    got, seen, lowest = Counter(), defaultdict(set), {}
    for x in out:
        got[x["phrase"]] += x["c"]
        seen[x["phrase"]] |= {("apart", x["page"])} if x["apart"] else {(k, x["page"], x["pos"], x["at"]) for k in range(x["pages"])}
        where = (x["page"] is not None, x["page"] or 0, x["pos"], x["at"])
        lowest[x["phrase"]] = min(lowest.get(x["phrase"], where), where)
        assert x["n"] == len(x["phrase"].split()) and x["example"].lower() == x["phrase"]
    assert got == count and lowest == first
    assert {g: len(s) for g, s in seen.items()} == {g: len(s) for g, s in pages.items()}
    assert dealt or len(out) < 0.85 * sum(len(s) for s in pages.values())


def test_maximal_repeats(spark):
    """maximal_repeat_dedup: against counting everything, texts of two words and repeated pairs with one or several neighbours among them."""
    r = random.Random(6)
    texts = [" ".join(r.choice("abcdefghijklmnop") * r.randrange(1, 4) for _ in range(r.choice([1, 2, 2, 3, 30]))) for _ in range(120)] + ["only two", "twice met", "twice met", "p q r", "p q r", "", None]
    count = Counter(" ".join(w[i : i + n]) for w in ((t or "").split() for t in texts) for n in (2, 3) for i in range(len(w) - n + 1))
    gone = {s for g, c in count.items() if len(w := g.split()) == 3 for s in (" ".join(w[:2]), " ".join(w[1:])) if count[s] == c}
    df = spark.createDataFrame([(t if t is None else t.split(),) for t in texts], "t array<string>").repartition(3)
    got = grams.maximal_repeats(df, "t")
    assert sorted((x.phrase, x["count"]) for x in got.collect()) == sorted((g, c) for g, c in count.items() if g not in gone)
    assert {"only two", "twice met", "p q r"} <= set(count) - gone and {"p q", "q r"} <= gone
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert grams.maximal_repeats(df.limit(0), "t").count() == 0


@pytest.mark.parametrize("power", [9, 28])
def test_maximal_repeats_of_up_to_six_words(spark, monkeypatch, power):
    """maximal_repeat_dedup: two to six words, against counting everything; with filters that admit nearly all what comes once is counted, too."""
    monkeypatch.setattr(grams, "LEAST_BITS", min(power, 16))
    monkeypatch.setattr(grams, "MOST_BITS", power)
    r = random.Random(7)
    some = [" ".join(r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(r.choice([1, 2, 3, 4, 5, 6, 7, 40]))) for _ in range(150)]
    texts = [*some, *some[:30], *(x + " end" for x in some[30:50]), "only four words here", "five words come here twice", "five words come here twice", "z " * 50, "", None]
    count = Counter(" ".join(w[i : i + n]) for w in ((t or "").split() for t in texts) for n in range(2, 7) for i in range(len(w) - n + 1))
    gone = {s for g, c in count.items() if len(w := g.split()) > 2 for s in (" ".join(w[:-1]), " ".join(w[1:])) if count[s] == c}
    df = spark.createDataFrame([(t if t is None else t.split(),) for t in texts], "t array<string>").repartition(3)
    got = grams.maximal_repeats(df, "t", 6).collect()
    assert sorted((x.phrase, x["count"]) for x in got) == sorted((g, c) for g, c in count.items() if g not in gone)
    assert {"only four words here", "five words come here twice"} <= set(count) - gone and {len(x.phrase.split()) for x in got} == {2, 3, 4, 5, 6}


def test_maximal_repeats_store_and_shuffle_little(spark, monkeypatch):
    """maximal_repeat_dedup: words alone are stored; a place's longest repeated n-gram alone is shuffled, in few bytes."""
    stored = []
    monkeypatch.setattr(grams, "stored", lambda df, name, put=grams.stored: stored.append((name, df.columns)) or put(df, name))
    grams.maximal_repeats(spark.createDataFrame([(["a", "b", "c"],)] * 3, "t array<string>"), "t", 6)
    assert [c for name, c in stored if name == "texts"] == [["tokens"]]
    words = [f"w{i}" for i in range(3000)]
    known = {2: [1, 2], 3: [1]}
    batch = pa.RecordBatch.from_arrays([pa.array([[*words, "w1", "w2", "w3"]]), pa.array([[*range(3000), 1, 2, 3]], pa.list_(pa.int64()))], names=["tokens", "hashes"])
    by = {n: lambda x, n=n: np.isin(x, [grams._hashes(np.arange(i, i + n, dtype=np.uint64), n)[0] for i in known[n]]) for n in known}
    rows = [r for b in grams._windows(by)(iter([batch])) for t in grams._slices(iter([b])) for r in t.to_pylist()]
    key = lambda r: r["window"]
    assert sorted(rows, key=key) == [{"window": "w1 w2 w3", "left": None, "whole": False, "count_all": 2}, {"window": "w2 w3", "left": "w1", "whole": False, "count_all": 2}]
    r = random.Random(9)
    text = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(60_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([[hash(w) for w in text]], pa.list_(pa.int64()))], names=["tokens", "hashes"])
    packed = sum(len(x.as_py()) for b in grams._windows(dict.fromkeys(range(2, 7), ALL))(iter([batch])) for x in b.column(1))
    assert packed < 45 * 59_999  # the windows alone are 42 bytes each


def test_what_comes_once_is_not_shuffled():
    words = [f"w{i}" for i in range(3000)]
    tokens, numbers = [*words, "w1", "w2", "w3"], [*range(3000), 1, 2, 3]
    batch = pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([numbers], pa.list_(pa.int64()))], names=["tokens", "hashes"])
    known = np.array(numbers, np.int64).view(np.uint64)

    def filters(n):
        h, c = np.unique(grams._hashes(known, n), return_counts=True)
        return lambda x: np.isin(x, h[c > 1])

    by = {n: filters(n) for n in (2, 3)}
    out = [x for b in grams._repeated(by)(iter([batch])) for x in b.to_pylist()]
    assert sorted((x["phrase"], x["c"]) for x in out) == [("w1 w2", 2), ("w1 w2 w3", 2), ("w2 w3", 2)]
    assert sum(b.num_rows for b in grams._alone(by)(iter([batch]))) == 3001 - 2


def test_clauses_are_stored_once(spark, monkeypatch):
    """review_candidates: words and phrases read the same stored clauses."""
    from folioframe.plans import candidates, mining

    names = []
    for m in (candidates, mining, grams):
        monkeypatch.setattr(m, "stored", lambda df, name, put=m.stored: names.append((name, "surfaces" in df.columns)) or put(df, name))
    rows = spark.createDataFrame([(p, "The Red Fox, a Red Fox; the Red Fox ran") for p in range(4)], "p int, t string")
    got = candidates.review_candidates(mining.surface_clauses(rows, "p", "t"), "p", ["the"])
    assert sum(clauses for _, clauses in names) == 1
    assert ("red fox", 12, 4) in {(r.term, r.total, r.pages) for r in got.collect()}


def test_review_stores_and_shuffles_little(spark, monkeypatch):
    """review_candidates, glossary_seed: words alone are stored, and no row a word and page or a phrase and block is shuffled unpacked."""
    from folioframe.plans import candidates, mining

    stored = []
    for m in (candidates, mining, grams):
        monkeypatch.setattr(m, "stored", lambda df, name, put=m.stored: stored.append((name, df.columns)) or put(df, name))
    rows = spark.createDataFrame([(p, "The Red Fox, a Red Fox; the Red Fox ran") for p in range(4)], "p int, t string")
    candidates.review_candidates(mining.surface_clauses(rows, "p", "t"), "p", ["the"]).count()
    assert dict(stored)["clauses"] == ["p", "pos", "surfaces"] and "phrase-words" not in dict(stored)
    r = random.Random(2)
    phrases = sorted({" ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(3)) for _ in range(20_000)})
    n = len(phrases)
    cols = {"phrase": phrases, "n": pa.array([3] * n, pa.int32()), "apart": [False] * n, "page": [r.randrange(900) for _ in phrases], "c": [1] * n, "pages": [1] * n, "pos": pa.array([r.randrange(50) for _ in phrases], pa.int32()), "at": pa.array([r.randrange(9) for _ in phrases], pa.int32()), "example": phrases, "slice": pa.array([0] * n, pa.int32())}
    batches = pa.table(cols).to_batches()
    packed = list(grams._packing(iter(batches)))
    assert sum(len(x.as_py()) for b in packed for x in b.column(1)) < 20 * n  # 17 bytes are the phrase
    odd = pa.table({"a": pa.array(["", None, "é x", None, ""]), "b": pa.array([None] * 5, pa.string()), "c": [1, 2, 3, 4, 5]})
    assert all(grams._opened(pa.py_buffer(grams._shut(t))).to_pylist() == t.to_pylist() for t in (odd, odd.slice(1, 3), odd.slice(1, 1)))
    assert [x for b in grams._summing(1)(iter(packed)) for x in b.column(0).to_pylist()] == phrases


@pytest.mark.parametrize("dealt", [False, True])
def test_frequent_words(spark, monkeypatch, dealt):
    """review_candidates: words with their pages and capitals, pages whose rows are apart, longer than a block and without a key among them."""
    monkeypatch.setattr(grams, "HELD", 60)
    from folioframe.plans import mining

    r = random.Random(4)
    rows = [(None if p == 3 else p % 37, " ".join(r.choice("aa Aa bb Bb cc dd Ee ff".split()) + r.choice(["", ",", " "]) for _ in range(400 if p == 5 else r.randrange(1, 9)))) for p in range(60)] + [(50, "zz zz")]
    seen = spark.createDataFrame(rows, "p int, t string")
    x = grams.prepared(mining.surface_clauses(seen.repartition(5) if dealt else seen.coalesce(1), "p", "t"), "p", [])
    count, inner, capital, pages = Counter(), Counter(), Counter(), defaultdict(set)
    for p, t in rows:
        for clause in t.split(","):
            for i, w in enumerate(clause.split()):
                count[w.lower()] += 1
                inner[w.lower()] += i > 0
                capital[w.lower()] += i > 0 and w[0].isupper()
                pages[w.lower()].add(p)
    got = {x.word: (x["count"], x.pages, x.inner, x.capital) for x in grams.frequent_words(x, 3, grams.levels(x, 2, 3)).collect()}
    assert got == {w: (c, len(pages[w]), inner[w], capital[w]) for w, c in count.items() if c >= 3} and "zz" not in got


def test_examples_are_looked_up_for_the_listed_alone(spark, monkeypatch):
    """glossary_seed, review_candidates: no other phrase carries how it is written; the first by page, clause and place counts."""
    from folioframe.plans import candidates, mining

    stored = []
    for m in (candidates, mining, grams):
        monkeypatch.setattr(m, "stored", lambda df, name, put=m.stored: stored.append((name, df.columns)) or put(df, name))
    rows = spark.createDataFrame([(p, f"x, the {'RED' if p == 2 else 'Red'} Fox; red fox ran" if p > 1 else "the rEd fOx") for p in range(1, 6)] * 2, "p int, t string").repartition(3)
    clause = mining.surface_clauses(rows, "p", "t")
    got = {r.term: r.example for r in candidates.review_candidates(clause, "p", ["the"]).collect()}
    assert got["red fox"] == "rEd fOx" and "example" not in dict(stored)["candidate-phrases"]
    x = grams.prepared(clause.where("p > 1"), "p", ["the"])
    assert {r.phrase: r.example for r in grams.first_examples(x, spark.createDataFrame([("red fox",), ("red fox ran",)], "phrase string")).collect()} == {"red fox": "RED Fox", "red fox ran": "red fox ran"}
