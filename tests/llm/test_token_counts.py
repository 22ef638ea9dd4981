import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rejoinder.llm.frames import BATCH_BYTES
from rejoinder.llm.token_counts import count_tokens
from tests.llm.conftest import TEXTS, ordered

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    whole = Tokenizer.from_file(PATH)
    return ordered((k, len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for k, t in rows)


def test_counts_are_the_librarys(spark, odd_docs):
    assert ordered(map(tuple, count_tokens(odd_docs, PATH).collect())) == expected(TEXTS)


@pytest.mark.parametrize("block", [1, 64])
def test_blocks_of_any_size(spark, block):
    rows = [(i, f"doc {i} <|endoftext|><|endoftext|>\n\n  the cat's {'ab ' * i}") for i in range(40)]
    found = count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH, block_bytes=block)
    assert ordered(map(tuple, found.collect())) == expected(rows)


def test_no_rows(no_docs):
    assert count_tokens(no_docs, PATH).collect() == []


def test_batches_are_bounded(spark, odd_docs):
    spark.conf.unset(BATCH_BYTES)
    try:
        found = count_tokens(odd_docs, PATH)
        assert spark.conf.get(BATCH_BYTES) == f"{4 << 20}b"
        assert ordered(map(tuple, found.collect())) == expected(TEXTS)
    finally:
        spark.conf.unset(BATCH_BYTES)
