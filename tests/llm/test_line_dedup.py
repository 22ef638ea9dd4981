import random
import re

from rejoinder.llm import line_dedup
from rejoinder.llm.line_dedup import drop_lines, line_report, repeated_lines
from tests.llm.conftest import TEXTS


def brute(rows, percent):
    lines = [
        (k, i, frozenset(w for w in re.split("[ \t\r]", line.lower()) if w))
        for k, t in sorted((k, t) for k, t in rows if k is not None and t is not None)
        for i, line in enumerate(t.split("\n"))
    ]
    lines = [x for x in lines if x[2]]
    return sorted(
        {
            (k, i)
            for k, i, x in lines
            if any((q, j) < (k, i) and 100 * len(x & y) >= percent * len(x | y) for q, j, y in lines)
        }
    )


def check(spark, rows, percent=line_dedup.PERCENT):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, repeated_lines(docs, percent).collect())) == brute(rows, percent)


def made(rng, lines, groups):
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(500)]
    base = [rng.choices(vocabulary, k=rng.randint(3, 40)) for _ in range(groups)]
    rows = []
    for i in range(lines):
        words = list(rng.choice(base)) if rng.random() < 0.7 else rng.choices(vocabulary, k=rng.randint(1, 40))
        for _ in range(rng.choice((0, 0, 1, 2, 5))):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**5)}"
        rows.append((i // 4, " ".join(words)))
    texts = {}
    for k, line in rows:
        texts.setdefault(k, []).append(line)
    return [(k, "\n".join(v)) for k, v in texts.items()]


def test_like_brute_force(spark):
    check(spark, made(random.Random(1), 600, 20))
    check(spark, made(random.Random(2), 400, 60), 75)


def test_dense_groups_go_through_leaders(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    check(spark, rows)


def test_odd_rows(spark, odd_docs, no_docs):
    removed = repeated_lines(odd_docs)
    assert sorted(map(tuple, removed.collect())) == brute(TEXTS, line_dedup.PERCENT) == [(2, 0)]
    report = line_report(odd_docs.select("doc_id", "text"), removed).collect()
    assert len(report) == len(TEXTS) and {r.doc_id: r.removed for r in report}[2] == [0]
    kept = drop_lines(odd_docs, removed)
    assert kept.schema.names == odd_docs.schema.names and kept.count() == len(TEXTS) - 1
    assert repeated_lines(no_docs).collect() == []
    assert drop_lines(no_docs, repeated_lines(no_docs)).collect() == []


def test_lines_go_and_the_rest_stays(spark):
    rows = [(1, "a b c d e f g\nshort\n\nlast  one"), (2, "first here\nA B C\tD E F G\nshort\nend"), (3, "a b c d e f g")]
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in rows], "doc_id long, text string, n_chars int")
    found = {r.doc_id: (r.text, r.n_chars) for r in drop_lines(docs, repeated_lines(docs)).collect()}
    assert found == {1: (rows[0][1], len(rows[0][1])), 2: ("first here\nend", 14)}


def test_short_lines(spark):
    rng = random.Random(9)
    words = ["a", "B", "b", "cc", "d", "日本", "=", "", "\t", "e"]
    rows = [(k, "\n".join(" ".join(rng.choices(words, k=rng.randint(0, 4))) for _ in range(rng.randint(0, 6)))) for k in range(60)]
    rows += [(100 + k, " ".join(f"w{i}" for i in range(n))) for k, n in enumerate((8, 9, 9, 10, 8, 7, 10, 11, 19, 20, 18))]
    check(spark, rows)
    check(spark, rows, 50)
    check(spark, rows, 100)


def test_long_lines_of_few_words_go(spark):
    lines = ["https://example.com/a/very/long/address?of=one&word=only", "日本語の文には空白がありませんので一語です", "again and " * 6, "=" * 40 + " ="]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["own", *lines, " " * 40])), (3, " " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, repeated_lines(docs).collect())) == [(2, i) for i in range(1, 5)]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = repeated_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_pairs_cost_one_intersection(spark):
    rows = [(1, "a b c d e f g h i j\nother"), (2, "A B C D E F G H I J k a"), (3, "a b c d e f g h x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 0, 2, 0), (1, 0, 3, 0), (2, 0, 3, 0)], "xdoc_id long, xline_no int, ydoc_id long, yline_no int")
    found = line_dedup._verified(docs, pairs, 90)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect") == 1 and "array_distinct" not in plan
    assert list(map(tuple, found.collect())) == [(2, 0)]


def test_long_lines_are_told_apart_before_their_words_are_read(spark):
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(1000)]
    rows = []
    for i in range(40):
        words = rng.sample(pool, 140) + [f"rare{i // 2}x{j}" for j in range(10)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    rows += [(40 + i, rows[i][1] + " more") for i in range(0, 40, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = line_dedup._classes(line_dedup._ranked(docs, 90))
    pairs = line_dedup._with_all(classes, classes, 90)
    found = {(r.xdoc_id, r.ydoc_id) for r in pairs.collect()}
    assert {(i, 40 + i) for i in range(0, 40, 8)} <= found and len(found) < 12
    check(spark, rows)


def test_classes_are_combined_without_sorting(spark):
    ids = (-(2**63), -7, 0, 2**63 - 1)
    docs = spark.createDataFrame([(k, f"same line here\nown {k}\nHERE same line") for k in ids], "doc_id long, text string")
    classes = line_dedup._classes(line_dedup._ranked(docs, 90))
    plan = classes._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    found = {(r.doc_id, r.line_no, r.several) for r in classes.collect()}
    assert found == {(-(2**63), 0, True), *((k, 1, False) for k in ids)}
    check(spark, [(r.doc_id, r.text) for r in docs.collect()])


def test_lines_around_the_length_from_which_a_second_picture_counts(spark):
    words = [f"w{i}" for i in range(2 * line_dedup.FULL)]
    sizes = range(line_dedup.FULL - 4, line_dedup.FULL + 5)
    rows = [(k, " ".join(words[:n])) for k, n in enumerate(sizes)] + [(20 + k, " ".join(["x", *words[1:n]])) for k, n in enumerate(reversed(sizes))]
    check(spark, rows)
    ranked = {r.n: r.sparse for r in line_dedup._ranked(spark.createDataFrame(rows, "doc_id long, text string"), 90).collect()}
    assert {n for n, sparse in ranked.items() if sparse} == {n for n in sizes if n > line_dedup.FULL}


def test_ids_of_any_kind(spark):
    texts = ["same line here\nown one", "HERE same line\nown two"]
    for kind, ids in (("int", (-4, 3)), ("string", ("a", "b"))):
        found = repeated_lines(spark.createDataFrame(list(zip(ids, texts)), f"doc_id {kind}, text string"))
        assert found.schema["doc_id"].dataType.simpleString() == kind and list(map(tuple, found.collect())) == [(ids[1], 0)]


def test_lines_are_found_with_one_look_at_their_classes(spark):
    docs = spark.createDataFrame([(1, "a b c\nd"), (2, "C b a\ne"), (2, "C b a\ne")], "doc_id long, text string")
    found = repeated_lines(docs)
    report = line_report(docs, found)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2  # of lines with the classes of several, of documents with their lists
    assert {(r.doc_id, *r.removed) for r in report.collect()} == {(1,), (2, 0)}


def test_texts_without_needed_lines_are_not_parted(spark, monkeypatch):
    parted = []
    monkeypatch.setattr(line_dedup, "_lines", lambda docs, lines=line_dedup._lines: parted.append(docs) or lines(docs))
    docs = spark.createDataFrame([(k, f"a {k}\nb {k}") for k in range(200)], "doc_id long, text string")
    needed = spark.createDataFrame([(7, 1), (11, 0)], "doc_id long, line_no int")
    found = line_dedup._needed_lines(docs, needed)
    assert {(7, 1, "b 7"), (11, 0, "a 11")} <= set(map(tuple, found.collect()))
    assert parted[0].count() < 10


def test_lines_are_counted_like_parts(spark):
    rows = [(1, ""), (2, "\n"), (3, "a\n\nb\n"), (4, None), (5, "日本\n語")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = spark.createDataFrame([], "doc_id long, line_no int")
    report = line_report(docs, removed)
    assert dict(report.select("doc_id", "n_lines").collect()) == {k: 0 if t is None else len(t.split("\n")) for k, t in rows}
    assert report.schema["n_lines"].dataType.simpleString() == "int"
    assert "split" not in report._jdf.queryExecution().optimizedPlan().toString()
