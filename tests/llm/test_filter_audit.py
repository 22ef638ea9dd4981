import random
import re
from itertools import permutations

import pytest

from rejoinder.llm.filter_audit import Diagram, adjacent_swaps, audit_filters, audit_part, text_mask

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int, mask string"


def brute_mask(text):
    words = WORD.findall(text)
    upper = sum("A" <= c <= "Z" for c in text)
    fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 2 * len(text), bool(set(text) & set("#$%&*|")))
    return {name for name, fail in zip("ABCD", fails) if fail}


def brute(docs, labels):
    """Every order applied to every document, filter by filter."""
    held = []
    for key, text, part in docs:
        text = text or ""
        fails = brute_mask(text)
        if key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in docs):
            fails.add("E")
        own = [label for label in labels if key is not None and label[0] == key]
        held.append((part or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    rows = set()
    for part in {h[0] for h in held}:
        mine = [h for h in held if h[0] == part]
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [h for h in left if name in h[1]]
                left = [h for h in left if name not in h[1]]
                shapley[name] += len(gone)
                redundant = sum(name in h[1] for h in mine) - len(gone)
                alone = sum(h[1] == {name} for h in mine)
                found.append(("".join(order), step, len(left), len(gone), redundant, alone, sum(h[2] for h in gone), sum(h[3] for h in gone), name))
        rows |= {(part, *f[:-1], shapley[f[-1]]) for f in found}
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_diagram_like_brute_force(seed):
    rng = random.Random(seed)
    counts = {m: (n := rng.choice((0, 1, 1, 5, 9)), rng.randint(0, n), 0) for m in range(32) if rng.random() < 0.7}
    held = [({"ABCDE"[i] for i in range(5) if m >> i & 1}, j < c[1]) for m, c in counts.items() for j in range(c[0])]
    found = {(r[0], r[1]): r[2:] for r in audit_part(counts)}
    assert len(found) == 600
    for order in permutations("ABCDE"):
        left = held
        for step, name in enumerate(order, 1):
            gone = [h for h in left if name in h[0]]
            left = [h for h in left if name not in h[0]]
            kept, removed, redundant, alone, good, toxic, _ = found["".join(order), step]
            assert (kept, removed, good, toxic) == (len(left), len(gone), sum(h[1] for h in gone), 0)
            assert (redundant, alone) == (sum(name in h[0] for h in held) - len(gone), sum(h[0] == {name} for h in held))


def test_swaps_keep_the_diagram_reduced():
    counts = {m: (m % 3, 0, 0) for m in range(32)}
    diagram = Diagram(5, counts, (0, 0, 0))
    for level in adjacent_swaps(5):
        diagram.swap(level)
        for i, nodes in enumerate(diagram.levels):
            assert len(set(nodes)) == len(nodes) <= 2**i
            assert {p for node in nodes for p in node} == set(range(len(diagram.weights[i + 1])))
        assert diagram.weights[0][0][0] == sum(c[0] for c in counts.values())


def test_pieces_of_long_texts():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("abA \t\n\x0b\x1c é#") for _ in range(rng.randint(0, 60))) * rng.choice((1, 1, 30))
        wanted = sum(1 << "ABCD".index(name) for name in brute_mask(text))
        assert text_mask(text.encode(), 7) == text_mask(text.encode()) == wanted


def test_like_brute_force(spark):
    rng = random.Random(2)
    texts = ["", None, "a b " * 150, "A " * 250, " ".join(f"w{i}" for i in range(220)), " ".join(f"W{i}" for i in range(300)) + "\x1c|", "short"]
    docs = [(i, rng.choice(texts), rng.choice(("x", "y", None, ""))) for i in range(120)]
    docs += [(None, "short", "x"), (7, "twice", "z"), (7, "twice", "z"), (-3, "twice", "z")]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None)), "?") for i in range(0, 120, 2)]
    labels += [(4, 1, 0, "?"), (4, 0, 1, "?"), (None, 1, 1, "?"), (999, 1, 1, "?")]
    given = spark.createDataFrame([(*d, "?", "?", "?", "?") for d in docs], "doc_id long, text string, source string, key string, part string, least string, n string")
    found = [tuple(r) for r in audit_filters(given, spark.createDataFrame(labels, LABELS)).collect()]
    assert len(found) == len(set(found)) == 600 * len({d[2] or "" for d in docs})
    assert set(found) == brute(docs, labels)


def test_odd_and_no_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], LABELS)
    found = audit_filters(odd_docs, labels).collect()
    assert len(found) == 600 and {r.part for r in found} == {""}
    assert {r.kept + r.removed for r in found if r.step == 1} == {odd_docs.count()}
    assert audit_filters(no_docs, labels).collect() == []
