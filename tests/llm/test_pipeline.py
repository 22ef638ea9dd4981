import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from rejoinder.llm.frames import BATCH_BYTES, bound_batches
from tests.llm.test_decontamination import lcs
from tests.llm.test_line_dedup import brute as repeated
from tests.llm.test_near_dedup import brute as components
from tests.llm.test_packing import check as check_pieces

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, every output written and read again."""
    docs, kept = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF_DIR).write.parquet(path)
        after = spark.read.parquet(path)
        kept.append((docs, after))
        docs = after
    return dict(zip((n for n, _ in corpus_pipeline.STAGES), kept))


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns_stay(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_toxicity(stages):
    before, after = map(rows, stages["toxicity"])
    assert set(after) < set(before)


def test_lines(stages):
    before, after = map(rows, stages["line_dedup"])
    gone = set(repeated(before, 90))
    wanted = []
    for k, text in before:
        lines = text.split("\n")
        left = "\n".join(line for i, line in enumerate(lines) if (k, i) not in gone)
        if left.strip() or not any((k, i) in gone for i in range(len(lines))):
            wanted.append((k, left))
    assert after == wanted and len(gone) > 0


def test_documents(stages):
    before, after = map(rows, stages["near_dedup"])
    first = {k for k, _, c in components(before) if k == c}
    assert after == [r for r in before if r[0] in first]


def test_benchmark(spark, stages):
    before, after = map(rows, stages["decontamination"])
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    left = {k for k, _ in after}
    for k, text in before:
        words = text.lower().split()
        holds = any(" ".join(i) in " ".join(words) for i in items)
        assert not (holds and k in left)
        assert k in left or any(lcs(i, words) >= 0.7 * len(i) for i in items)


def test_packing(stages):
    before, after = stages["packing"]
    check_pieces(after.collect(), rows(before), 4096)


def test_run(spark, stages):
    found = contract.queries()["pipeline"](spark, SF_DIR)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = sum(len(whole.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows(stages["packing"][0]))
    assert sum(r.length for r in found.collect()) == wanted


def test_names(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_batches_are_bounded_unless_the_session_says_otherwise(spark):
    before = spark.conf.get(BATCH_BYTES)
    try:
        for given, wanted in (("67108864b", "1048576b"), ("8m", "8m"), ("1048576b", "1048576b")):
            spark.conf.set(BATCH_BYTES, given)
            bound_batches(spark, 1 << 20)
            assert spark.conf.get(BATCH_BYTES) == wanted
    finally:
        spark.conf.set(BATCH_BYTES, before)
