import random

from rejoinder.llm.decontamination import common_subsequence, drop_contaminated, find_items
from tests.llm.conftest import TEXTS


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    import numpy as np

    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert common_subsequence(np.array(a, int), b) == lcs(a, b)


def corpus(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]

    def words(n):
        return rng.choices(vocabulary, weights, k=n)

    items = [words(rng.randint(12, 60)) for _ in range(30)]
    rows, wanted = [], {}
    for k in range(400):
        text = words(rng.randint(0, 300))
        if k % 4 == 0:
            i = rng.randrange(30)
            item = list(items[i])
            if k % 8 == 0:  # reworded: a word in eight replaced, another put in
                for at in range(3, len(item), 8):
                    item[at] = rng.choice(("other", "else"))
                item.insert(len(item) // 2, "indeed")
            at = rng.randint(0, len(text))
            text[at:at] = item
            wanted[k] = i
        rows.append((k, " ".join(text).upper() if k % 3 else "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"), wanted


def test_planted_items_are_found_and_nothing_else(spark):
    docs, benchmark, wanted = corpus(spark)
    found = {(r.doc_id, m.item) for r in find_items(docs, benchmark).collect() for m in r.matches}
    assert found >= set(wanted.items())
    assert {k for k, _ in found} == set(wanted)
    assert sorted(r.doc_id for r in drop_contaminated(docs, benchmark).collect()) == [k for k in range(400) if k not in wanted]


def test_copies_of_short_items_are_found(spark):
    """Copies word for word of items of 1 to 16 words, and items in a script without blanks."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    items = [[f"only{n}", *rng.choices(vocabulary, weights, k=n - 1)] for n in range(1, 17) for _ in range(5)]
    rows = []
    for i, item in enumerate(items):
        text = rng.choices(vocabulary, weights, k=160)
        text[i:i] = item
        rows.append((i, " ".join(text).upper()))
        rows.append((1000 + i, " ".join(rng.choices(vocabulary, weights, k=160))))
    items = [[f"only{n}x{i}" if w == f"only{n}" else w for w in item] for i, item in enumerate(items) for n in [len(item)]]
    rows = [(k, t.replace(f"ONLY{len(items[k])} ", f"ONLY{len(items[k])}X{k} ") if k < 1000 else t) for k, t in rows]
    texts = [(i, " ".join(w)) for i, w in enumerate(items)] + [(500, "日本の首都はどこですか"), (501, " ")]
    rows += [(2000, "昔々、日本の首都はどこですか？東京です。"), (2001, "昔々、日本の首都は"), (2002, "どこですか")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, m.item) for r in find_items(docs, spark.createDataFrame(texts, "item_id long, text string")).collect() for m in r.matches}
    assert found == {(i, i) for i in range(80)} | {(2000, 500)}


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = [(r.item_id, " ".join(r.text.lower().split())) for r in benchmark.collect()]
    wanted = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in " ".join(r.text.lower().split())}
    found = {(r.doc_id, m.item) for r in find_items(docs, benchmark).collect() for m in r.matches}
    assert found == wanted


def test_odd_rows(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame(
        [(1, "one two three four five six seven eight nine ten"), (2, None), (3, ""), (4, "too short"), (None, "a b c d e f g h i")],
        "item_id long, text string",
    )
    found = find_items(odd_docs, benchmark).collect()
    assert len(found) == len(TEXTS) and {r.doc_id for r in found if r.matches} == {1, 2}
    kept = drop_contaminated(odd_docs, benchmark)
    assert kept.schema.names == odd_docs.schema.names and kept.count() == len(TEXTS) - 2
    assert find_items(no_docs, benchmark).collect() == [] and drop_contaminated(no_docs, benchmark).collect() == []
    assert all(not r.matches for r in find_items(odd_docs, benchmark.limit(0)).collect())
    assert drop_contaminated(odd_docs, benchmark.limit(0)).count() == len(TEXTS)
