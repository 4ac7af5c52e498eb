"""Exact top-k search by inner product on a bit-sliced index.

Vectors are quantised to integers. The index holds blocks of rows as bit slices: for every dimension
and bit one bitmap over the rows of the block, after the block's smallest value of the dimension is
taken off. A query's score of all rows of a block is a sum of weighted slices: the weight of a
dimension is written in signed binary digits, each digit puts the dimension's slices, or their
complements, on the pile of its power of two, and the piles are added up by carry-save adders with
bitmap arithmetic. That leaves the score itself as slices. The top rows are chosen from the most
significant slice downward: rows with the bit are taken if they are fewer than wanted, and are the
only ones left in question if they are more. What is in question after the last slice ties at the
boundary and is resolved exactly by the smaller id, the order of the rows in a block.

Every block of queries meets every block of the index, both of bounded size; the best k per query and
block are merged. Queries are many bitmaps side by side, so one step serves a group of them.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewise.sources.storage import staged

INDEX_BLOCK = 8192  # rows
QUERY_BLOCK = 256
_GROUP = 32  # queries per step
_LIMIT = 1 << 60  # largest size of a quantised component


def quantised(embedding: str | Column, scale: int) -> Column:
    """floor(scale * x) of every component as array<long>; null where a vector takes no part.

    A vector takes no part if it is null or has a null, NaN or infinite component. A finite component whose
    quantised size passes 2 to the 60 is an error, as the vector would be missing from the result.
    """
    vector = (F.col(embedding) if isinstance(embedding, str) else embedding).cast("array<double>")
    scaled = F.transform(vector, lambda x: F.floor(x * scale))
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    fits = F.forall(vector, lambda x: F.abs(x) <= _LIMIT // scale)
    oversized = F.raise_error(F.lit(f"a vector has a component above {_LIMIT // scale}")).cast("array<bigint>")
    return F.when(sound & fits, scaled.cast("array<bigint>")).when(sound, oversized)


class IndexBlock:
    """Slices of a block of rows, which are ordered by id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        rows = rows[order].astype(np.int64)
        low = rows.min(axis=0) if rows.size else np.zeros(rows.shape[1], np.int64)
        above = rows - low
        bits = [int(top).bit_length() for top in (above.max(axis=0) if rows.size else low)]
        words = -(-len(ids) // 64)
        padded = np.zeros((words * 64, rows.shape[1]), np.int64)
        padded[: len(ids)] = above
        slices = [_bitmap((padded[:, d] >> bit) & 1) for d, n in enumerate(bits) for bit in range(n)]
        self._set(ids[order], low, np.array(bits, np.int64), np.stack(slices) if slices else np.zeros((0, words), np.uint64))

    def _set(self, ids: np.ndarray, low: np.ndarray, bits: np.ndarray, real: np.ndarray) -> None:
        self.ids, self.low, self.bits, self.real = ids, low, bits, real
        self.words = -(-len(ids) // 64)
        # slice 0 is empty; then all slices, then their complements
        self.slices = np.concatenate([np.zeros((1, self.words), np.uint64), real, ~real])
        self.first = np.concatenate([[1], 1 + np.cumsum(bits)])[:-1].astype(np.int64)
        self.complement = len(real)
        valid = np.zeros(self.words * 64, np.int64)
        valid[: len(ids)] = 1
        self.valid = _bitmap(valid)

    def packed(self) -> dict:
        """The block as a row of the index."""
        parts = {"ids": self.ids, "low": self.low, "bits": self.bits, "slices": self.real}
        return {"n": [len(self.ids)], **{name: [part.tobytes()] for name, part in parts.items()}}

    @classmethod
    def unpacked(cls, n: int, ids: bytes, low: bytes, bits: bytes, slices: bytes) -> "IndexBlock":
        block = cls.__new__(cls)
        widths = np.frombuffer(bits, np.int64)
        real = np.frombuffer(slices, np.uint64).reshape(int(widths.sum()), -(-n // 64))
        block._set(np.frombuffer(ids, np.int64), np.frombuffer(low, np.int64), widths, real)
        return block

    def fitted(self, dims: int) -> "IndexBlock":
        """The block with at least so many dimensions: shorter vectors have zeros at their end."""
        more = max(0, dims - len(self.low))
        if more:
            zeros = np.zeros(more, np.int64)
            self._set(self.ids, np.concatenate([self.low, zeros]), np.concatenate([self.bits, zeros]), self.real)
        return self

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the k best rows of other ids; a query is its place in ``queries``."""
        groups = [slice(i, i + _GROUP) for i in range(0, len(queries), _GROUP)]
        found = [self._search(query_ids[group], queries[group].astype(np.int64), k) for group in groups]
        queried = [query + group.start for group, (query, _, _) in zip(groups, found, strict=True)]
        return np.concatenate(queried), *(np.concatenate(part) for part in list(zip(*found, strict=True))[1:])

    def _search(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        score, offset = self.scores(queries)
        open_rows = np.repeat(self.valid[None, :], len(queries), axis=0)
        first, last = np.searchsorted(self.ids, query_ids), np.searchsorted(self.ids, query_ids, "right")
        for q, (a, b) in enumerate(zip(first, last, strict=True)):
            for row in range(a, b):
                open_rows[q, row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
        taken = np.zeros_like(open_rows)
        wanted = np.minimum(k, np.bitwise_count(open_rows).sum(axis=1, dtype=np.int64))
        have = np.zeros(len(queries), np.int64)
        for bitmap in reversed(score):
            with_bit = open_rows & bitmap
            count = np.bitwise_count(with_bit).sum(axis=1, dtype=np.int64)
            fits = (have + count <= wanted)[:, None]
            taken |= np.where(fits, with_bit, 0)
            open_rows = np.where(fits, open_rows & ~bitmap, with_bit)
            have += np.where(fits[:, 0], count, 0)
        taken_query, taken_row = _set_bits(taken)
        edge_query, edge_row = _set_bits(open_rows)  # by query, and by id inside a query
        turn = np.arange(len(edge_query)) - np.searchsorted(edge_query, edge_query)
        resolved = turn < (wanted - have)[edge_query]
        query = np.concatenate([taken_query, edge_query[resolved]])
        row = np.concatenate([taken_row, edge_row[resolved]])
        value = offset[query]
        for bit, bitmap in enumerate(score):
            value = value + ((bitmap[query, row // 64] >> (row % 64).astype(np.uint64)) & np.uint64(1)).astype(value.dtype) * (1 << bit)
        if value.dtype == object and len(value) and max(abs(int(v)) for v in value) >= 1 << 63:
            raise OverflowError("a score passes 64 bits")
        return query, self.ids[row], value.astype(np.int64)

    def scores(self, queries: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The scores as slices from the lowest bit, each (query, word), less an offset per query."""
        n, dims = queries.shape
        tops = [max(abs(int(low)), abs(int(low) + (1 << int(bits)))) for low, bits in zip(self.low, self.bits)]
        largest = sum(int(q) * top for q, top in zip(np.abs(queries).max(axis=0, initial=0), tops))
        # sums that could pass 64 bits are made of Python's whole numbers; slices are as wide as the sums need
        offset = (queries.astype(object) if largest >> 60 else queries) @ self.low[:dims]
        piles: dict[int, list[list[int]]] = {}
        sizes = np.abs(queries)
        for power, digit in _signed_digits(sizes):
            digit = digit * np.sign(queries)
            for d in range(dims):
                if not self.bits[d] or not digit[:, d].any():
                    continue
                # -x is the complement of x, less the largest value the slices can hold
                offset = offset - (digit[:, d] < 0).astype(offset.dtype) * (((1 << int(self.bits[d])) - 1) << power)
                for bit in range(int(self.bits[d])):
                    at = int(self.first[d]) + bit
                    pile = piles.setdefault(power + bit, [[] for _ in range(n)])
                    for q in np.flatnonzero(digit[:, d]):
                        pile[q].append(at if digit[q, d] > 0 else at + self.complement)
        score: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        power = 0
        while carried or any(p >= power for p in piles):
            rows, carried = carried, []
            pile = piles.get(power, [])
            height = max(map(len, pile), default=0)
            index = np.zeros((height, n), np.int64)
            for q, own in enumerate(pile):
                index[: len(own), q] = own
            rows += [self.slices[level] for level in index]
            while len(rows) >= 3:
                a, b, c = rows.pop(), rows.pop(), rows.pop()
                half = a ^ b
                rows.insert(0, half ^ c)
                carried.append((a & b) | (half & c))
            if len(rows) == 2:
                carried.append(rows[0] & rows[1])
                rows = [rows[0] ^ rows[1]]
            score.append(rows[0] if rows else np.zeros((n, self.words), np.uint64))
            power += 1
        return score, offset


def _bitmap(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)


def _set_bits(bitmaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.unpackbits(bitmaps.view(np.uint8), axis=1, bitorder="little"))


def _signed_digits(sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(power, digit -1, 0 or 1): no two neighbours are set, so about a third are."""
    left, power = sizes.astype(np.int64), 0
    while left.any():
        digit = np.where(left & 1, 2 - (left & 3), 0)
        yield power, digit
        left = (left - digit) >> 1
        power += 1


def _table(rows: list) -> np.ndarray:
    table = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)  # a shorter vector has zeros at its end
    for i, row in enumerate(rows):
        table[i, : len(row)] = row
    return table


def _packed(ids: list, rows: list) -> dict:
    return {"n": [len(ids)], "ids": [np.array(ids, np.int64).tobytes()], "rows": [_table(rows).tobytes()]}


def _sliced(ids: list, rows: list) -> dict:
    return IndexBlock(np.array(ids, np.int64), _table(rows)).packed()


def _blocks(size: int, packed):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list = []
        rows: list = []
        for batch in batches:
            for at in range(0, len(batch), size):
                ids += batch["id"].iloc[at : at + size].tolist()
                rows += batch["vector"].iloc[at : at + size].tolist()
                while len(ids) >= size:
                    yield pd.DataFrame(packed(ids[:size], rows[:size]))
                    del ids[:size], rows[:size]
        if ids:
            yield pd.DataFrame(packed(ids, rows))

    return pack


def _searcher(k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                query_ids = np.frombuffer(row.query_ids, np.int64)
                queries = np.frombuffer(row.queries, np.int64).reshape(row.query_n, -1)
                block = IndexBlock.unpacked(row.n, row.ids, row.low, row.bits, row.slices).fitted(queries.shape[1])
                queries = np.pad(queries, ((0, 0), (0, len(block.low) - queries.shape[1])))
                query, found, score = block.search(query_ids, queries, k)
                yield pd.DataFrame(
                    {"query_no": row.query_no, "query_row": query, "query_id": query_ids[query], "vec_id": found, "score": score}
                )

    return search


def top_k_search(
    vectors: DataFrame, queries: DataFrame, k: int, index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the largest inner product to each query.

    Both tables have ``id`` (long) and ``vector`` (array<int> or array<long>); rows with a null in either take no part, extra
    columns do not count, and an empty table on either side gives no rows. A query never finds rows of its own id. Ties go to the smaller
    id; a query has fewer than k rows if there are fewer others. Shorter vectors count as filled up with zeros.
    Every row is a query, or a row to find, of its own: an id that two queries share has two lists of k,
    and one that two rows of ``vectors`` share can be found twice. A score past 64 bits is an error.
    """
    whole = "id is not null and vector is not null"
    cut, shape = _blocks(index_block, _sliced), "n long, ids binary, low binary, bits binary, slices binary"
    index = staged(vectors.where(whole).select("id", "vector").mapInPandas(cut, shape), "index")
    cut, shape = _blocks(query_block, _packed), "n long, ids binary, rows binary"
    asked = staged(queries.where(whole).select("id", "vector").mapInPandas(cut, shape), "queries")
    index = staged(index.withColumn("index_no", F.monotonically_increasing_id()), "index")
    asked = staged(asked.withColumn("query_no", F.monotonically_increasing_id()), "queries")
    # numbers of the blocks of the other side: one number for thousands of rows
    index_numbers, query_numbers = (
        df.agg(F.collect_list(c)).scalar() for df, c in ((index, "index_no"), (asked, "query_no"))
    )
    cells = index.count() * asked.count()
    spark = vectors.sparkSession
    parts = max(1, min(cells, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    left = index.withColumn("query_no", F.explode(query_numbers)).repartition(parts, "index_no", "query_no")
    right = asked.select(
        "query_no", F.col("n").alias("query_n"), F.col("ids").alias("query_ids"), F.col("rows").alias("queries")
    ).withColumn("index_no", F.explode(index_numbers)).repartition(parts, "index_no", "query_no")
    best = left.join(right, ["index_no", "query_no"]).mapInPandas(
        _searcher(k), "query_no long, query_row long, query_id long, vec_id long, score long"
    )
    place = F.row_number().over(Window.partitionBy("query_no", "query_row").orderBy(F.desc("score"), "vec_id"))
    ranked = best.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
