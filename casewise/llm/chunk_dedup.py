"""Exact dedup by recipes of content-defined chunks.

Every text, its white space made even, is cut where a rolling hash of its last ``WINDOW`` bytes says so, so equal
passages are cut alike wherever they lie. A chunk is named by a 128-bit hash, and a text's recipe is the
ordered list of these names: under a hundredth of the text, and all that is grouped and joined afterwards.

A name stands for a chunk once it is verified: chunks of documents whose recipes meet are brought together
by name and content, each distinct one once per task, and a name with several contents is split into
variants, which become part of the recipes. Recipes are then compared in full, so documents share a group if
and only if all their chunks are equal, in order. Texts never move as a whole.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewise.llm.frames import only_hashes
from casewise.sources.storage import staged

WINDOW = 32  # bytes that decide on a cut
LEAST, MOST = 512, 16_384  # bytes in a chunk, but for the last of a text
CUT_BITS = 11  # a cut every 2,048 bytes beyond the least size, on average
NAME_BYTES = 16
_RECIPE = ["n_bytes", "recipe"]
_BLOCK = 1 << 20  # bytes worked on at a time, in whole texts
_BASE = 0x5851F42D4C957F2D
_ODD = np.uint64(0x9E3779B97F4A7C15)


def even_spaces(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts that begin at ``starts``, with every run of ASCII white space as one space, and the new starts."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    again = np.zeros(len(data), bool)
    again[1:] = white[1:] & white[:-1]
    again[starts[starts < len(data)]] = False  # a run ends with its text
    upto = np.concatenate([[0], np.cumsum(~again)])
    return np.where(white, np.uint8(32), data)[~again], upto[starts]


def cut_places(data: np.ndarray) -> np.ndarray:
    """Ends of windows whose hash asks for a cut."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64)
    letters = (data.astype(np.uint64) + np.uint64(1)) * _ODD
    rolled = letters ^ (letters >> np.uint64(29))
    for step in (1, 2, 4, 8, 16):  # a window of 2 * step is two of step, side by side
        rolled = rolled[:-step] * np.uint64(pow(_BASE, step, 1 << 64)) + rolled[step:]
    return np.flatnonzero(rolled >> np.uint64(64 - CUT_BITS) == 0) + WINDOW


def chunk_ends(size: int, places: np.ndarray) -> list[int]:
    """Ends of the chunks of one text, from the places that ask for a cut."""
    ends, at = [], 0
    while at < size:
        i = int(np.searchsorted(places, at + LEAST))
        at = min(int(places[i]) if i < len(places) else size, at + MOST, size)
        ends.append(at)
    return ends


def even_texts(texts: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of every text with even spaces; null is empty."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        yield from [b""] * len(texts)
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    missing = np.asarray(texts.is_null())
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _BLOCK, "right")) - 1)
        starts = offsets[first : last + 1] - offsets[first]
        even, places = even_spaces(data[offsets[first] : offsets[last]], starts)
        for i, (a, b) in enumerate(zip(places[:-1], places[1:], strict=True)):
            yield b"" if missing[first + i] else even[a:b].tobytes()
        first = last


def chunks(text: bytes) -> list[bytes]:
    """The chunks of a text in order; their concatenation is the text."""
    ends = chunk_ends(len(text), cut_places(np.frombuffer(text, np.uint8)) if len(text) > LEAST else np.zeros(0, np.int64))
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def chunk_name(chunk: bytes, name_bytes: int = NAME_BYTES) -> bytes:
    return xxhash.xxh3_128_digest(chunk)[:name_bytes]


def _recipes(name_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recipes, digests, sizes = [], [], []
            for text in even_texts(batch.column("text")):
                recipes.append(b"".join([chunk_name(c, name_bytes) for c in chunks(text)]))
                digests.append(hashlib.sha256(text).hexdigest())
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(recipes, pa.binary()), pa.array(digests, pa.string())],
                ["key", "text_hash", "n_bytes", "recipe", "digest"],
            )

    return run


def _contents(name_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, at, size = [], [], [], 0
            for row, text in enumerate(even_texts(batch.column("text"))):
                parts = chunks(text)
                rows += [row] * len(parts)
                at += range(len(parts))
                found += parts
                size += len(text)
                if size > _BLOCK or row == len(batch) - 1:
                    of = batch.select(["key", "text_hash"]).take(pa.array(rows, pa.int64()))
                    names = [chunk_name(c, name_bytes) for c in found]
                    yield pa.RecordBatch.from_arrays(
                        [*of.columns, pa.array(at, pa.int32()), pa.array(names, pa.binary()), pa.array(found, pa.binary())],
                        ["key", "text_hash", "at", "name", "content"],
                    )
                    rows, found, at, size = [], [], [], 0

    return run


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("text_hash"))


def text_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", name_bytes: int = NAME_BYTES) -> DataFrame:
    """(key, text_hash, at, name, content): every chunk of every text, in the order of ``at``."""
    named = _keyed(docs, key, text)
    kind = named.schema["key"].dataType.simpleString()
    return named.mapInArrow(_contents(name_bytes), f"key {kind}, text_hash long, at int, name binary, content binary")


def _groups(rows: DataFrame, same_text: list[str]) -> DataFrame:
    """(head, group_size) of every group of several rows, written: joins can then split a group that fills many tasks."""
    place = F.struct(F.col("key").isNull().alias("unnamed"), F.col("key"), F.col("row"))
    groups = rows.groupBy(*same_text).agg(F.min(place).alias("head"), F.count("*").alias("group_size")).where("group_size > 1")
    return staged(groups.select(*[F.col(c).alias(f"_{c}") for c in same_text], "head", "group_size"), "groups")


def _same(same_text: list[str]) -> Column:
    same = F.lit(True)
    for c in same_text:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return same


def name_variants(
    docs: DataFrame, recipes: DataFrame, groups: DataFrame, key: str, text: str, name_bytes: int
) -> tuple[DataFrame, DataFrame] | None:
    """(name, content, variant) of names with several contents, and all chunks that may hold them; None if every name is verified.

    Only texts whose recipes meet, those of ``groups``, are verified, as far as their hashes can be broadcast. Beyond that,
    picking them out would move every text, so chunks of all texts are verified; that gives the same groups.
    """
    if groups.isEmpty():
        return None
    suspects = staged(recipes.join(groups, _same(_RECIPE), "left_semi").select("text_hash").distinct(), "suspects")
    hashed = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("text_hash"))
    docs = only_hashes(hashed, suspects, "text_hash").select(F.col("key").alias(key), F.col("text").alias(text))
    found = text_chunks(docs, key, text, name_bytes)
    distinct = found.select("name", "content").distinct()
    several = staged(distinct.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "several")
    if several.isEmpty():
        return None
    variant = F.row_number().over(Window.partitionBy("name").orderBy("content"))
    split = distinct.join(several, "name", "left_semi").withColumn("variant", variant)
    return staged(split, "variants"), found


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", name_bytes: int = NAME_BYTES) -> DataFrame:
    """(key, text_hash, keep_key, group_size, kept, digest) with one row for every row of ``docs``.

    Texts are equal if they are so with every run of ASCII white space as one space; null counts as empty, and empty texts
    are equal. ``keep_key`` is the smallest key of the group, null only where it has no other. ``kept`` is true in one row of
    the group: of rows that repeat that key, in one of them. ``text_hash`` is Spark's xxhash64 of the text as it
    is, ``digest`` the SHA-256 of the even text. Extra columns do not matter; an empty table gives no rows.
    ``name_bytes`` cuts the chunk names short, which makes more of them need verifying and changes no result.
    """
    named = _keyed(docs, key, text)
    kind = named.schema["key"].dataType.simpleString()
    schema = f"key {kind}, text_hash long, n_bytes long, recipe binary, digest string"
    recipes = staged(named.mapInArrow(_recipes(name_bytes), schema).withColumn("row", F.monotonically_increasing_id()), "recipes")
    groups, same = _groups(recipes, _RECIPE), _same(_RECIPE)
    found = name_variants(docs, recipes, groups, key, text, name_bytes)
    if found is not None:
        recipes = _with_variants(recipes, *found)
        groups, same = _groups(recipes, [*_RECIPE, "variants"]), _same([*_RECIPE, "variants"])
    joined = recipes.join(groups, same, "left")
    alone = F.col("head").isNull()
    return joined.select(
        "key",
        "text_hash",
        F.when(alone, F.col("key")).otherwise(F.col("head.key")).alias("keep_key"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("head.row"))).alias("kept"),
        "digest",
    )


def _with_variants(recipes: DataFrame, variants: DataFrame, found: DataFrame) -> DataFrame:
    """Recipes with the variants of their names in order; null where no name has several contents."""
    marked = found.join(variants, ["name", "content"]).select("key", "text_hash", "at", "variant").distinct()
    lists = marked.groupBy("key", "text_hash").agg(F.sort_array(F.collect_list(F.struct("at", "variant"))).alias("found"))
    lists = lists.select(F.col("key").alias("of"), F.col("text_hash").alias("of_hash"), F.col("found.variant").alias("variants"))
    same = F.col("key").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    return staged(recipes.join(lists, same, "left").drop("of", "of_hash"), "recipes")


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those whose text equals that of an earlier key; of repeated rows one stays."""
    found = staged(exact_duplicates(docs, key, text).select("key", "text_hash", "keep_key", "kept"), "copies")
    stays = found.where("kept").select(F.col("key").alias("of"), F.col("text_hash").alias("of_hash")).distinct()
    keyed = docs.select(F.struct("*").alias("row"), F.col(f"`{key}`").alias("key"), F.xxhash64(f"`{text}`").alias("text_hash"))
    same = F.col("key").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    left = keyed.join(stays, same, "left_semi")
    again = found.groupBy("key", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("of"), F.col("text_hash").alias("of_hash"))
    if again.isEmpty():
        return left.select("row.*")
    once = left.join(again, same, "left_anti")
    return once.unionByName(left.join(again, same, "left_semi").dropDuplicates(["key", "text_hash"])).select("row.*")


def chunk_store(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(name, content, copies): every distinct chunk once, with how often it occurs."""
    return text_chunks(docs, key, text).groupBy("name", "content").agg(F.count("*").alias("copies"))
