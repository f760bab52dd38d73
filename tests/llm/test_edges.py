"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

from tickflow.llm import (
    exact_dedup, licenses, line_runs, mixing, packing, quality, sharding, simhash, substrings, token_counts,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ROWS = [
    (1, "a b c\nd e f g h i j k l m n o p", "en", "s1", 3), (2, None, None, None, None), (3, "", "en", "s1", 0),
    (4, "   \n\t", "en", "s2", 5), (5, LONG, "en", "s1", 9), (6, LONG, "en", None, 9), (None, "a b c", "en", "s2", 5),
    (7, "same row", "en", "s3", 8), (7, "same row", "en", "s3", 8), (7, "other text", "en", "s3", 8), (8, "é ß 日本 \U0001F600", None, "s2", 1),
]
CLASHING = ["size", "copies", "row", "id", "key", "shard", "slot", "words", "digest", "rows", "keys", "fp", "lines", "score", "kept"]

REPORTS = {
    "mix": lambda d, l: mixing.mix_report(d),
    "shard": lambda d, l: sharding.shard_report(d),
    "pack": lambda d, l: packing.packed(d),
    "tokens": lambda d, l: token_counts.token_counts(d),
    "exact": lambda d, l: exact_dedup.exact_duplicates(d),
    "quality": lambda d, l: quality.quality_report(d, l),
    "simhash": lambda d, l: simhash.near_duplicates(d),
    "substrings": lambda d, l: substrings.substring_report(d),
    "licences": lambda d, l: licenses.licence_report(d, background_rows=50),
    "lines": lambda d, l: line_runs.line_report(d),
}
STAGES = {
    "quality": lambda d, l: quality.good_documents(d, l),
    "lines": lambda d, l: line_runs.deduplicated(d),
    "simhash": lambda d, l: simhash.one_of_each(d),
    "mix": lambda d, l: mixing.mixed(d),
}


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 1, None), (7, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", REPORTS)
def test_odd_rows_give_one_row_each_and_agree_on_a_rerun(docs, labels, name):
    got = REPORTS[name](docs, labels)
    if name != "pack":
        assert got.count() == len(ROWS)
    else:
        pieces = got.collect()
        assert sum(r.piece == 0 for r in pieces) == len(ROWS)
        used = {}
        for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
            assert used.get(r.sequence_id, 0) == r.offset
            used[r.sequence_id] = r.offset + r.length
        assert max(used.values()) <= 4096
    if name == "mix":
        assert _rows(got) == _rows(REPORTS[name](docs.repartition(2), labels))


@pytest.mark.parametrize("name", REPORTS)
def test_an_empty_table_gives_no_rows(docs, labels, name):
    assert REPORTS[name](docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_the_columns_of_documents_whatever_their_names(docs, labels, name):
    wide = docs.withColumns({c: F.lit("x") for c in CLASHING})
    out = STAGES[name](wide, labels)
    assert out.columns == wide.columns
    assert _rows(out.select(docs.columns)) == _rows(STAGES[name](docs, labels))
    assert STAGES[name](wide.limit(0), labels).count() == 0


@pytest.mark.parametrize("name", REPORTS)
def test_extra_columns_change_nothing(docs, labels, name):
    wide = docs.withColumns({c: F.lit("x") for c in CLASHING})
    assert set(REPORTS[name](wide, labels).columns) == set(REPORTS[name](docs, labels).columns)
