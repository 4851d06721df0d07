import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, rep string, words int, g int, pieces string, found int"


def prose(seed, n):
    r = random.Random(seed)
    syl = ["ba", "ko", "ri", "ten", "mu", "sol", "ve", "da", "in", "po"]
    return [r.choice(syl) + r.choice(syl) + r.choice(["", "n", "s"]) for _ in range(n)]


def rows():
    """(doc_id, text): nulls, empty and very long texts, ties, copies, near copies, shared passages, repeated rows."""
    long = prose(1, 30_000)
    base, passage, line = prose(2, 300), prose(3, 120), " ".join(prose(4, 14))
    out = [(0, None), (1, ""), (2, " \t\n "), (3, "a"), (4, "a"), (5, "one two three"), (6, " ".join(long)), (7, " ".join(long[:20_000])), (8, "x" * 5000), (9, "ab" * 1500)]
    for k in range(6):  # near copies, each with two changed words
        w = list(base)
        w[20 + 40 * k], w[200 + 10 * k] = f"q{k}", f"z{k}"
        out.append((10 + k, " ".join(w)))
    for k in range(5):  # a passage in other texts
        out.append((20 + k, " ".join(prose(50 + k, 80) + passage + prose(70 + k, 60))))
    for k in range(8):  # a common line
        out.append((30 + k, "\n".join([" ".join(prose(90 + k, 60)), line, " ".join(prose(110 + k, 60))])))
    out += [(40, " ".join(base)), (41, " ".join(base)), (42, " ".join(base).upper()), (43, "Ünïcödé ▁ 漢字   \x00 😀" * 30), (44, "1234 5678 !!!"), (45, " ".join(prose(2, 299)))]
    return out


@pytest.fixture(scope="session")
def fixture_rows():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, fixture_rows):
    """The rows with extra columns of clashing names; one row repeated, one without doc_id."""
    langs = ["en", "fr", None]
    full = [(i, t, langs[k % 3], [None, "b", "a"][k % 3], len(t or ""), 1, "r", 2, 3, "p", 4) for k, (i, t) in enumerate(fixture_rows)]
    full += [full[3], (None, "no id here at all " * 40, "en", "a", 1, 1, "r", 2, 3, "p", 4)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
