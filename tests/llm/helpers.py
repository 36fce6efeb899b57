"""Tables with everything that can be odd about documents; fixtures are imported where they are used."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# columns that operators make themselves, as columns of the input
CLASHING = "digest string, kept string, node string, shard string, score string, copies string, band string, next string"


def near(words: int, seed: int, change: int = 0) -> str:
    """A text of numbered words, ``change`` of them replaced at the end."""
    return " ".join(f"w{seed}x{i}" for i in range(words - change)) + "".join(f" c{seed}y{i}" for i in range(change))


AWKWARD = [
    (1, "one Two three", "en", "src1", 13),
    (2, "ONE two THREE", "en", "src1", 13),
    (2, "ONE two THREE", "en", "src1", 13),
    (3, None, "en", "src2", None),
    (4, "", None, "src2", 0),
    (5, " \t\n", "de", None, 3),
    (None, "no id at all", "de", "src3", 12),
    (None, "ONE two three", None, None, None),
    (6, "Éa 日本語 \U0001f600 text", "fr", "src4", 14),
    (7, "long " * 40_000, "en", "src5", 200_000),
    (8, "x" * 50_000, "en", "src5", 50_000),
    (9, "1" * 30_000 + " " + "@" * 3_000 + " " + "1 " * 5_000, "en", "src6", 1),
    (10, near(200, 1), "en", "src7", 1),
    (11, near(200, 1, 3), "en", "src7", 1),
    (12, near(200, 1, 150), "en", "src7", 1),
    (13, near(200, 1), "en", "src8", 1),
    (9, "another text under a used id", "es", "src9", 1),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns."""
    extra = [c.split()[0] for c in CLASHING.split(", ")]
    return spark.createDataFrame([r + ("x",) * len(extra) for r in AWKWARD], f"{SCHEMA}, {CLASHING}")


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def table_of(folder, name):
    import pyarrow.parquet as pq

    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()
