"""What a worker holds at once is bounded by bytes, not by 10,000 rows of any length."""

import pyarrow as pa
import pytest

from quiltmap.llm import line_dedup, minhash_dedup, packing, substring_dedup, toxicity
from quiltmap.llm.common import BATCH_BYTES, in_small_batches

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
CALLS = {
    "near_dedup": minhash_dedup.near_dedup,
    "line_dedup": line_dedup.line_dedup,
    "pack": lambda docs: packing.pack(docs, path=packing.default_path()),
    "score": lambda docs: toxicity.score(docs, toxicity.Lexicon({}, ())),
    "substring_dedup": substring_dedup.substring_dedup,
}


def largest_batch(docs) -> int:
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return max(r.n for r in docs.coalesce(1).mapInArrow(sizes, "n long").collect())


@pytest.mark.parametrize("name", CALLS)
def test_batches_of_long_texts_are_small(spark, name):
    own = spark.newSession()
    docs = own.range(3000).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 1000) AS text")
    CALLS[name](docs)
    assert largest_batch(docs) <= 1.1 * BATCH_BYTES


def test_a_value_of_the_session_stays(spark):
    own = spark.newSession()
    own.conf.set(KEY, 1 << 20)
    in_small_batches(own)
    assert own.conf.get(KEY) == str(1 << 20)


def test_word_hashes_are_bounded_and_the_same_again():
    few = minhash_dedup.WordHashes()
    few.LARGEST = 100
    first = [few[str(i).encode()] for i in range(1000)]
    assert len(few) <= 100 and [few[str(i).encode()] for i in range(1000)] == first
    assert minhash_dedup.WordHashes.LARGEST <= 1 << 16


def test_substring_dedup_remembers_few_words_and_splits_a_run_at_a_time(monkeypatch):
    monkeypatch.setattr(substring_dedup, "REMEMBERED", 100, raising=True)
    known = substring_dedup.WordHashes()
    first = [known[str(i).encode()] for i in range(1000)]
    long = known[b"x" * 33]
    assert len(known) <= 100 and b"x" * 33 not in known and known[b"x" * 33] == long
    assert [known[str(i).encode()] for i in range(1000)] == first
    taken = []

    def column():
        for i in range(6):
            taken.append(i)
            yield b"a b c" if i != 3 else None

    runs = substring_dedup.spelled(column(), 6)
    assert next(runs) == (0, [[b"a", b"b", b"c"]] * 2) and taken == [0, 1, 2]
    assert [(begin, len(run)) for begin, run in runs] == [(2, 3), (5, 1)]
