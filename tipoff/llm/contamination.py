"""Benchmark decontamination by a distributed positional inverted index.

The index is document-partitioned: a map task takes a shard of documents (about SHARD_BYTES of text, or one longer text), encodes
its words against the shard's own term dictionary (by bytes, no hashes) and stores, for every term, the ascending positions at
which it stands. A shard is a row of a written table (dictionary, list lengths, position lists, documents), so building the
index needs no shuffle, a hot word is only a longer list inside each shard, and an index can be searched again for other tests.

A search first sums each test term's occurrences over all shards (only dictionaries and list lengths are read). In each shard, a
test window starts with the list of its rarest term, shifted by the term's place in the window, and is intersected with the
shifted lists of its other terms, rarest first; what remains are exact phrase matches, cut to those inside one document. A
proximity match is a stretch of at most WITHIN words of one document that holds all of an item's NEAR_TERMS rarest distinct
terms, found from the list of the rarest one.

Test items are taken in blocks of about BLOCK_BYTES, dealt by a hash of the item_id (of the text where that is null), and a block is sent to the shards; several
blocks are several passes over the index, whose matches are united for each document.

Defined results: null and empty texts have no words and no hits; an item without words has no window; items that share an
item_id are listed once; windows of items without item_id hit words but name no item; rows that share a doc_id, or have none,
are searched each; empty tables give no rows, or documents without hits; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, _text, runs

WINDOW, SHARD_BYTES, BLOCK_BYTES = 10, 4 << 20, 4 << 20
NEAR_TERMS, WITHIN = 4, 20
#: A-Z become a-z; words are runs of digits, letters a-z and all that isn't ASCII.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
MEMBER = np.zeros(256, bool)
MEMBER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SHARD = "shard long, terms binary, lengths binary, counts binary, positions binary, doc_id array<long>, n_words array<long>"
MATCH = "shard long, at int, doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>, near array<struct<item:string,start:int,end:int>>"


def words(data: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of several texts as one binary array, and the number in each text."""
    data = FOLD[data]
    s, e, row = _text.word_bounds(data, offs, MEMBER)
    ends = np.r_[0, np.cumsum(e - s)].astype(np.int64)
    flat = data[MEMBER[data]]  # words are maximal runs, so their bytes stand one after the other
    array = pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    return array, np.bincount(row, minlength=len(offs) - 1)


def pack_terms(terms: pa.Array) -> tuple[bytes, bytes]:
    """A dictionary as its terms' bytes and their lengths."""
    ends = np.frombuffer(terms.buffers()[1], np.int64, len(terms) + 1, terms.offset * 8)
    return zstandard.ZstdCompressor(level=1).compress(terms.buffers()[2] or b""), runs.pack(np.diff(ends).astype(np.uint32))


def unpack_terms(terms: bytes, lengths: bytes) -> pa.Array:
    ends = np.r_[0, np.cumsum(runs.unpack(lengths, np.uint32), dtype=np.int64)]
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(zstandard.ZstdDecompressor().decompress(terms) or b"\0")])


@_common.tidy
def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run of documents as a row of the index."""
    number = TaskContext.get().partitionId() << 32
    for b in batches:
        for i, j, data, offs in _text.slices(b, "text", SHARD_BYTES):
            array, n = words(data, offs)
            coded = array.dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            key = np.sort(codes << 32 | np.arange(len(codes)))  # by term, then by position
            position = key & 0xFFFFFFFF
            counts = np.bincount(codes, minlength=len(coded.dictionary))
            step = np.diff(position, prepend=0)
            first = np.cumsum(counts) - counts
            step[first] = position[first]  # a list's first position, then its distances
            yield pa.RecordBatch.from_pydict(
                dict(zip(("shard", "terms", "lengths", "counts", "positions", "doc_id", "n_words"), ([number], *([x] for x in pack_terms(coded.dictionary)), [runs.pack(counts.astype(np.uint32))], [runs.pack(step.astype(np.uint32))], [b.column("doc_id")[i:j]], [n]), strict=True)),
                schema=pa.schema([("shard", pa.int64()), *((c, pa.binary()) for c in ("terms", "lengths", "counts", "positions")), ("doc_id", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64()))]),
            )
            number += 1


def build(docs: DataFrame, scratch: _common.Scratch) -> DataFrame:
    """The written index of the documents' whole texts."""
    _common.ship(docs.sparkSession)
    return scratch.keep(_common.columns(docs, doc_id="long", text="string").mapInArrow(_shards, SHARD), "index")


class Tests:
    """A block of test items: its terms, distinct windows and the items of each."""

    def __init__(self, rows: list[tuple[str | None, str]], window: int) -> None:
        texts = [t.encode() for _, t in rows]
        array, n = words(np.array(bytearray(b"".join(texts)), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64))
        coded = array.dictionary_encode()
        self.terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = sorted({i for i, _ in rows if i is not None})
        number = {i: k for k, i in enumerate(names)}
        self.names = np.array(names, object)
        found: dict[tuple, set[int]] = {}
        self.bags: dict[int, set[int]] = {}  # distinct terms of each item_id
        end = 0
        for (item, _), size in zip(rows, n.tolist(), strict=True):
            own, end = code[end : end + size].tolist(), end + size
            k = number.get(item, -1)
            if own and k >= 0:
                self.bags.setdefault(k, set()).update(own)
            for s in range(max(1, size - window + 1) if own else 0):
                found.setdefault(tuple(own[s : s + window]), set()).add(k)
        self.size = np.array([len(w) for w in found], np.int64)
        self.window = np.full((len(found), window), -1)
        for r, w in enumerate(found):
            self.window[r, : len(w)] = w
        lists = [sorted(x - {-1}) for x in found.values()]
        self.item = np.array([k for x in lists for k in x], np.int64)  # items of window r: item[lim[r] : lim[r + 1]]
        self.lim = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)

    def weigh(self, counts: np.ndarray, near_terms: int) -> None:
        """Order each window's places by its terms' occurrences in all documents; choose each item's rarest terms (ties by their bytes)."""
        seen = np.where(self.window >= 0, counts[self.window], np.iinfo(np.int64).max)
        self.order = np.argsort(seen, axis=1, kind="stable")
        alive = (seen > 0).all(1)  # a term that no document has rules its windows out
        self.live = np.flatnonzero(alive)
        raw = self.terms.to_pylist()
        rare = [(k, sorted(bag, key=lambda t: (counts[t], raw[t]))[:near_terms]) for k, bag in sorted(self.bags.items())]
        self.rare = [(k, t) for k, t in rare if all(counts[t] > 0)]


def _counts(batches: Iterator[pa.RecordBatch], tests: Tests) -> Iterator[pa.RecordBatch]:
    """Occurrences of the test's terms in a task's shards."""
    total = np.zeros(len(tests.terms), np.int64)
    for b in batches:
        for terms, lengths, counts in zip(*(b.column(c).to_pylist() for c in ("terms", "lengths", "counts")), strict=True):
            at = places(tests.terms, unpack_terms(terms, lengths))
            total += np.where(at >= 0, np.r_[runs.unpack(counts, np.uint32), 0][at], 0)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])


def places(terms: pa.Array, dictionary: pa.Array) -> np.ndarray:
    """Each term's number in a dictionary, or -1."""
    return pc.fill_null(pc.index_in(terms, value_set=dictionary), -1).to_numpy(zero_copy_only=False).astype(np.int64)


class Lists:
    """The position lists of one shard."""

    def __init__(self, counts: bytes, positions: bytes) -> None:
        self.n = runs.unpack(counts, np.uint32).astype(np.int64)
        self.first = np.cumsum(self.n) - self.n
        step = runs.unpack(positions, np.uint32).astype(np.int64)
        run = np.cumsum(step)
        lead = run[self.first] - step[self.first] if len(step) else run  # what earlier lists have added
        self.position = run - np.repeat(lead, self.n)
        self.key = np.repeat(np.arange(len(self.n)), self.n) << 32 | self.position

    def of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of each code: the code's place in the argument, and the position."""
        n = self.n[code]
        who = np.repeat(np.arange(len(code)), n)
        return who, self.position[np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + self.first[code][who]]

    def has(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each code's list has a position from low to high - 1."""
        at = np.searchsorted(self.key, code << 32 | low)
        return (at < len(self.key)) & (np.r_[self.key, 0][at] < (code << 32 | high)) if len(self.key) else np.zeros(len(code), bool)


def phrases(lists: Lists, at: np.ndarray, edge: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, first words and documents of all exact matches in a shard; at: the dictionary's number of each test term."""
    code = np.where(tests.window[tests.live] >= 0, at[tests.window[tests.live]], 0)
    live = tests.live[(code >= 0).all(1)]
    order = tests.order[live]
    who, start = lists.of(at[tests.window[live, order[:, 0]]])
    start = start - order[who, 0]
    who, start = who[start >= 0], start[start >= 0]
    for k in range(1, tests.window.shape[1]):
        place = order[who, k]
        term = tests.window[live[who], place]
        ok = term < 0  # shorter windows end earlier
        some = np.flatnonzero(~ok)
        where = start[some] + place[some]
        ok[some] = lists.has(at[term[some]], where, where + 1)
        who, start = who[ok], start[ok]
    doc = np.searchsorted(edge, start, "right") - 1
    inside = start + tests.size[live[who]] <= edge[doc + 1]
    return live[who[inside]], start[inside], doc[inside]


def proximity(lists: Lists, at: np.ndarray, edge: np.ndarray, tests: Tests, within: int) -> list[tuple[int, int, int]]:
    """(document, item, first word) of the first stretch of `within` words of each document that holds all of an item's rarest terms."""
    out = []
    for item, terms in tests.rare:
        code = at[np.array(terms)]
        if (code < 0).any():
            continue
        _, p = lists.of(code[:1])
        doc = np.searchsorted(edge, p, "right") - 1
        for c in code[1:]:
            ok = lists.has(np.full(len(p), c), np.maximum(p - within + 1, edge[doc]), np.minimum(p + within, edge[doc + 1]))
            p, doc = p[ok], doc[ok]
        if not len(p):
            continue
        s = np.maximum(p[:, None] - within + 1 + np.arange(within), edge[doc][:, None])  # stretches that hold p
        end = np.minimum(s + within, edge[doc + 1][:, None])
        ok = np.ones(s.shape, bool)
        for c in code[1:]:
            ok &= lists.has(np.full(s.size, c), s.ravel(), end.ravel()).reshape(s.shape)
        row, col = np.nonzero(ok)
        d, first = np.unique(doc[row], return_index=True)  # p ascends, and so do the stretches of one p
        out += [(int(x), item, int(s[row[f], col[f]])) for x, f in zip(d, first, strict=True)]
    return out


@_common.tidy
def _search(batches: Iterator[pa.RecordBatch], tests: Tests, within: int) -> Iterator[pa.RecordBatch]:
    """Every document of each shard with its matches."""
    schema = pa.schema([("shard", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string())), ("near", pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])
    for b in batches:
        for r in range(b.num_rows):
            get = lambda c, r=r, b=b: b.column(c)[r]
            n = get("n_words").values.to_numpy(zero_copy_only=False)
            edge = np.r_[0, np.cumsum(n)]
            at = places(tests.terms, unpack_terms(get("terms").as_py(), get("lengths").as_py()))
            spans, items, near = ([[] for _ in n] for _ in range(3))
            if (at >= 0).any():
                lists = Lists(get("counts").as_py(), get("positions").as_py())
                who, start, doc = phrases(lists, at, edge, tests)
                o = np.lexsort((start, doc))
                who, start, doc = who[o], start[o], doc[o]
                for d in np.unique(doc):
                    own = slice(*np.searchsorted(doc, [d, d + 1]))
                    s, e = _text.merge_spans(start[own] - edge[d], start[own] - edge[d] + tests.size[who[own]])
                    spans[d] = [{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)]
                    seen = np.unique(np.concatenate([tests.item[tests.lim[w] : tests.lim[w + 1]] for w in np.unique(who[own])]))
                    items[d] = tests.names[seen].tolist()
                for d, k, s in proximity(lists, at, edge, tests, within):
                    near[d].append({"item": tests.names[k], "start": s - int(edge[d]), "end": int(min(s + within, edge[d + 1]) - edge[d])})
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([get("shard").as_py()] * len(n), np.arange(len(n), dtype=np.int32), get("doc_id").values, n, spans, items, near), schema, strict=True)], schema=schema)


def search(index: DataFrame, items: DataFrame, scratch: _common.Scratch, window: int = WINDOW, near_terms: int = NEAR_TERMS, within: int = WITHIN) -> DataFrame:
    """doc_id, n_words, spans (words that test windows cover, half-open), items (whose windows occur) and near (proximity matches) of each document."""
    t = _common.columns(items, item_id="string", text="string").filter("text is not null")
    size = t.agg(F.sum(F.octet_length("text").cast("long"))).collect()[0][0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    parts = []
    for k in range(blocks):
        block = t.filter(F.pmod(F.xxhash64(F.coalesce("item_id", "text")), F.lit(blocks)) == k) if blocks > 1 else t
        tests = Tests([(r.item_id, r.text) for r in block.distinct().collect()], window)  # about BLOCK_BYTES
        counts = np.zeros(len(tests.terms), np.int64)
        of_term = index.select("terms", "lengths", "counts").mapInArrow(lambda it, x=tests: _counts(it, x), "term long, n long")
        for r in of_term.groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row for each of the block's terms
            counts[r.term] = r.n
        tests.weigh(counts, near_terms)
        parts.append(index.mapInArrow(lambda it, x=tests: _search(it, x, within), MATCH))
    if blocks == 1:
        return parts[0].drop("shard", "at")
    parts = [scratch.keep(p, "matches") for p in parts]
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p.filter(F.size("spans") + F.size("near") > 0))
    flat = lambda c: F.flatten(F.collect_list(c))
    first = all_.groupBy("shard", "at").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), flat("spans").alias("spans"), F.array_distinct(flat("items")).alias("items"), flat("near").alias("near"))
    return first.drop("shard", "at")


def n_hit(spans: str | Column) -> Column:
    """Words that half-open spans cover, each once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    step = lambda a, x: F.struct((a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["upto"]), F.lit(0))).cast("long").alias("n"), F.greatest(a["upto"], x["end"]).alias("upto"))
    return F.aggregate(F.array_sort(spans), zero, step)["n"]


def decontaminate(docs: DataFrame, items: DataFrame, **named) -> DataFrame:
    """Every document with its contaminated stretches: see search."""
    scratch = _common.Scratch(docs.sparkSession)
    return search(build(docs, scratch), items, scratch, **named)


def op13_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns, and n_near: items of which the document has a proximity match."""
    found = decontaminate(_common.table(spark, sf_dir, "documents"), _common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", n_hit("spans").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near"),
    )


#: Words, windows, occurrences and stretches as plain relations.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, (SELECT DISTINCT n FROM bw) AS k, unnest(range(1, len(w) - n + 2)) AS u(i)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM m, unnest(range(i, i + n)) AS u(p) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY r),
dt AS (SELECT r, i, w[i] AS t FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
f AS (SELECT t, count(*) AS c FROM dt GROUP BY t),
bt AS (SELECT DISTINCT item, unnest(w) AS t FROM b WHERE item IS NOT NULL),
rare AS (SELECT item, t, c, row_number() OVER (PARTITION BY item ORDER BY coalesce(c, 0), encode(t)) AS k FROM bt LEFT JOIN f USING (t) QUALIFY k <= 4),
need AS (SELECT item, count(*) AS n FROM rare GROUP BY item HAVING count(c) = count(*)),
spot AS (SELECT r, item, i, t FROM dt JOIN rare USING (t) JOIN need USING (item)),
near AS (SELECT r, count(DISTINCT item) AS n_near FROM (SELECT x.r, x.item, x.i FROM spot AS x JOIN spot AS y ON x.r = y.r AND x.item = y.item AND y.i BETWEEN x.i AND x.i + 19 JOIN need ON need.item = x.item
  GROUP BY x.r, x.item, x.i, need.n HAVING count(DISTINCT y.t) = need.n) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN near USING (r)
"""

QUERIES = {"op13_benchmark_index": op13_benchmark_index}
ORACLE: dict[str, str] = {"op13_benchmark_index": SQL}
