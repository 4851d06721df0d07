"""Benchmark decontamination against brute force."""

import brute
import pytest
from conftest import prose
from pyspark.sql import functions as F

from tipoff.llm import _common, contamination


def texts():
    item = prose(200, 40)
    spread = [x for w in item[:12] for x in (w, "filler")]
    return {
        "items": [(1, " ".join(item)), (2, "Short ITEM, of five words!"), (2, " ".join(prose(201, 15))), (10, " ".join(item[5:30])), (None, " ".join(prose(202, 12))), (3, None), (4, ""), (5, "-- !!"), (6, "ünï çödé"), (7, "word"), (8, "never seen anywhere at all x1 x2 x3 x4 x5 x6 x7")],
        "docs": [
            None, "", " .,;", " ".join(item), " ".join(item[:9]), " ".join(item[:10]), "so: " + " ".join(item[3:20]).upper() + " end", " ".join(prose(202, 12)), "x short item of\nFIVE-words y", "short item of", "ÜNÏ ünï çödé",
            " ".join(spread), " ".join(prose(300, 500) + item[10:25] + prose(301, 500) + item[30:40]), "word " * 3000, " ".join(item * 50), "\x00word\x00 \x7fa", " ".join(prose(201, 15) + item + prose(201, 15)), " ".join(item),
        ],
    }


@pytest.mark.parametrize("shard", [contamination.SHARD_BYTES, 300])
def test_matches_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(contamination, "SHARD_BYTES", shard)
    x = texts()
    docs = spark.createDataFrame([(k if k % 5 else None, t, "n", k) for k, t in enumerate(x["docs"])], "doc_id long, text string, items string, n_words int").repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in x["items"]], "item_id long, text string, near int")
    got = contamination.decontaminate(docs, items)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.hit, r["items"], r.n) for r in got.select("*", contamination.n_hit("spans").alias("hit"), F.array_sort("items").alias("i"), F.array_sort("near.item").alias("n")).drop("items").withColumnRenamed("i", "items").collect())
    want = sorted((k % 5 == 0, k if k % 5 else 0, *b) for k, b in enumerate(brute.contamination(x["docs"], x["items"])))
    assert got == want


def test_near_places_hold_the_terms(spark):
    x = texts()
    docs = spark.createDataFrame(list(enumerate(x["docs"])), "doc_id long, text string")
    rows = contamination.decontaminate(docs, spark.createDataFrame(x["items"], "item_id long, text string")).collect()
    assert any(n.end - n.start <= contamination.WITHIN and r.n_words >= n.end for r in rows for n in r.near) and all(n.end - n.start <= contamination.WITHIN for r in rows for n in r.near)


def test_blocks_of_items_are_united(spark, monkeypatch):
    x = texts()
    docs, items = spark.createDataFrame(list(enumerate(x["docs"])), "doc_id long, text string"), spark.createDataFrame(x["items"], "item_id long, text string")

    def rows(df):
        return sorted((r.doc_id, r.n_words, r.hit, sorted(r["items"]), sorted(n["item"] for n in r.near)) for r in df.select("*", contamination.n_hit("spans").alias("hit")).collect())

    one = rows(contamination.decontaminate(docs, items))
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 100)
    assert rows(contamination.decontaminate(docs, items)) == one


def test_empty_tables_and_a_stored_index(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.decontaminate(no_docs, none).count() == 0
    rows = contamination.decontaminate(docs, none).collect()
    assert len(rows) == docs.count() and all(not r["items"] and not r.spans and not r.near for r in rows)
    scratch = _common.Scratch(spark)
    index = contamination.build(docs, scratch)
    some = spark.createDataFrame([("a", "one two three")], "item_id string, text string")
    assert [r.doc_id for r in contamination.search(index, some, scratch).filter(F.size("items") > 0).collect()] == [5]
    assert contamination.search(index, none, scratch).filter(F.size("items") > 0).count() == 0
