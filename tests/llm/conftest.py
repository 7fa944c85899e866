import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Columns that a result or a helper of some operator is called too.
CLASHES = ("row", "size", "score", "n_lines", "kept", "host", "taken", "component", "class", "bin", "_row", "predicted")
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        *[StructField(c, StringType()) for c in CLASHES],
    ]
)


def sentence(rng, n):
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta", "Lambda", "zeta", "Éta", "xi"]
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", ","]) for _ in range(n))


def odd_rows():
    """Prose, copies, near copies, shared lines, nulls, blanks, ties, repeats, one very long text."""
    rng = random.Random(7)
    texts = ["\n".join(sentence(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    texts += ["Shared footer LINE \n" + t for t in texts[:12]]
    texts += [t.replace("alpha", "alfa", 1) for t in texts[:8]] + texts[:5]
    texts += [None, "", "   \n\t\n", "one", "two words", "\x1c odd\x85space  x"]
    texts += [sentence(rng, 30_000), "a" * 200_000, "x\n" * 3000, "w w w w " * 30]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, texts[3], None, None, None), (None, None, "en", None, 0), rows[5], rows[5], rows[40]]
    return [r + tuple("clash" for _ in CLASHES) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, 1 if i % 3 else 0, 0) for i in range(0, 60)] + [(1, None, 0), (None, 1, 0), (4, 7, 0)],
        "doc_id long, quality int, toxic int",
    )
