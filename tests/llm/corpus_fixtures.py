"""Fixtures of the corpus operators' tests."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, stem: str = "w") -> str:
    """Words that depend on the seed alone."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"{stem}{x >> 13}")
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, short and very long texts, ties, copies,
    repeated rows and extra columns with the operators' own names."""
    base = prose(1, 120)
    rows = [(1, base), (2, base), (3, base.replace("w1", "x1", 2)), (4, None), (5, ""), (6, "  \n\t "), (7, "lone"),
            (8, prose(2, 4)), (9, prose(3, 30000)), (10, "é漢字𝄞 " + prose(4, 60) + "\n"), (11, prose(5, 80) + " " + base),
            (12, prose(5, 80)), (None, prose(6, 50)), (13, "12345 !!! ???"), (14, base), (14, base)]
    docs = spark.createDataFrame([(i, t, "en" if i and i % 2 else None if i == 4 else "fr",
                                   None if i == 7 else "hot" if i and i < 12 else "small", len(t or "")) for i, t in rows], DOCS)
    return docs.withColumns({"score": F.lit("x"), "component_id": F.lit(1), "band": F.lit(2.5), "place": F.lit("p"),
                             "key": F.lit(0), "ids": F.lit("i")}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)



SF_SMALL = "/root/testdata/sf0.001"


def near_copies(n: int) -> list[tuple[int, str]]:
    """Copies of one text with one to four words changed each, and others that
    share only its first half."""
    words = [f"t{i * i % 997}a{i}" for i in range(120)]
    out = []
    for k in range(n):
        own = list(words)
        for j in range(1 + k % 4):
            own[(k * 31 + j * 37) % 120] = f"z{k}q{j}"
        if k % 5 == 4:
            own[60:] = [f"o{k}r{i}" for i in range(60)]
        out.append((k, " ".join(own)))
    return out
