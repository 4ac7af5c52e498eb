"""Phrases of words that occur together, from an FM-index per shard of the corpus.

Texts are read once and become shards: the words of one language, as ids of the shard's own dictionary, with a
break between pieces. A shard's index has the Burrows-Wheeler transform of its ids, forward and backward, of suffixes
sorted as deep as phrases may be long. A phrase is an interval of rows in both: the transform's symbols in its rows
are the words beside it, their counts are its extensions, and each extension is an interval again. All intervals of
one length are extended at once, to the right and to the left in turn, so every phrase of the shard comes up once,
with its count.

A phrase is never more frequent than what it is made of, so shards ask three times what can be frequent over all of
them: which words; then which pairs, with breaks in place of rare words; then which longer phrases, with a break in
every rare pair. They ask in sorted hashes, a few bytes a phrase: counts are summed up by hash, and each shard hears which of its own
hashes have a sum that suffices. Phrases that share a hash only seem more frequent than they are. What is left is
summed up as text, exactly.

A phrase is dropped if a longer one has it in all its places, which then holds for one of its extensions by one word.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from casewise.sources.storage import drop_staged, staged

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
SHARD_WORDS = 1 << 20
PART_WORDS = 1 << 21  # words of the corpus for each range of hashes that is summed up in one task
_BREAK = b"\xff"  # never a byte of UTF-8
# A piece ends at these, and at line breaks; a tab parts words as a space does.
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")


class _Numbers(dict):
    """Numbers words in the order in which they come up; the break is 0."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def split_words(text: bytes) -> list[bytes]:
    """Words of a text, A-Z as a-z, with a break between pieces."""
    return text.lower().translate(_TABLE).replace(_BREAK, b" " + _BREAK + b" ").split()


class _Shard:
    """The texts of a language met so far in a task."""

    def __init__(self):
        self.numbers = _Numbers()
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        words = split_words(text.encode("utf-8", "surrogatepass"))
        words.append(_BREAK)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, lang: str) -> dict:
        tokens = np.concatenate(self.parts)
        counts = np.bincount(tokens, minlength=len(self.numbers))[1:]
        return {
            "lang": lang,
            "tokens": zstandard.compress(tokens.tobytes(), 1),
            "words": [word.decode("utf-8", "surrogatepass") for word in self.numbers if word != _BREAK],
            "counts": counts,
        }


_SHARD_SCHEMA = pa.schema(
    [("lang", pa.string()), ("tokens", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
)


def _sharded(shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, _Shard] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                text = text.as_py()
                if not text:
                    continue
                lang = lang.as_py()
                if lang not in open_shards:
                    open_shards[lang] = _Shard()
                open_shards[lang].add(text)
                if open_shards[lang].size >= shard_words:
                    yield pa.RecordBatch.from_pylist([open_shards.pop(lang).row(lang)], _SHARD_SCHEMA)
        for lang, shard in open_shards.items():
            yield pa.RecordBatch.from_pylist([shard.row(lang)], _SHARD_SCHEMA)

    return run


class PhraseIndex:
    """A bidirectional FM-index over word ids; 0 is a break, which no phrase has in it.

    Suffixes are sorted by their first ``depth`` ids only, which is as deep as an interval is ever asked for.
    """

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids = np.concatenate([[0], ids, [0]]).astype(np.int64)
        self.n = len(self.ids)
        self.symbols = int(self.ids.max()) + 1
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(self.ids, minlength=self.symbols))])
        self.forward = self._transform(self.ids, depth)
        self.backward = self._transform(self.ids[::-1], depth)

    @staticmethod
    def _transform(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The transform, and its (symbol, row) keys in order, from which ranks are read."""
        n, rank, known = len(ids), ids, 1
        order = np.argsort(ids, kind="stable")
        while known < depth:  # prefix doubling: twice the depth from the ranks of both halves
            pair = rank * (int(rank.max()) + 1) + np.roll(rank, -known)
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], pair[1:] != pair[:-1]]))
            known *= 2
        before = ids[order - 1]
        return before.astype(np.int32), np.sort(before * n + np.arange(n))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of one word, as (ids, first row forward, first row backward, count)."""
        found = np.flatnonzero(np.diff(self.starts)[1:]) + 1
        first = self.starts[found]
        return found[:, None], first, first.copy(), self.starts[found + 1] - first

    def extended(self, phrases, to_right: bool):
        """All phrases with one word more, in the same form.

        The symbols before the rows of an interval are what stands beside the phrase. The interval of a longer phrase begins at
        its symbol's rank in one direction, and after the rows of smaller symbols in the other.
        """
        ids, forward, backward, counts = phrases
        transform, keys = self.backward if to_right else self.forward
        near, far = (backward, forward) if to_right else (forward, backward)
        of = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + near[of]
        beside, many = np.unique(of * self.symbols + transform[rows], return_counts=True)
        parent, symbol = beside // self.symbols, beside % self.symbols
        upto = np.cumsum(many) - many
        smaller = upto - upto[np.searchsorted(parent, parent)]
        real = symbol > 0
        parent, symbol, many, smaller = parent[real], symbol[real], many[real], smaller[real]
        there = np.searchsorted(keys, symbol * self.n + near[parent])
        here = far[parent] + smaller
        parts = [ids[parent], symbol[:, None]] if to_right else [symbol[:, None], ids[parent]]
        both = (here, there) if to_right else (there, here)
        return np.concatenate(parts, axis=1), *both, many

    def phrases(self, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, counts) of all phrases of 2, 3, ... ``depth`` words."""
        found = self.words()
        for length in range(2, depth + 1):
            found = self.extended(found, to_right=length % 2 == 0)
            if not len(found[0]):
                return
            yield found[0], found[3]


def _tokens(shard: pa.Table) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(shard.column("tokens")[0].as_py()), np.int32)


def _without_lone_words(ids: np.ndarray) -> np.ndarray:
    """Without words between two breaks, and with one break for several: neither is in a phrase."""
    edge = np.concatenate([[0], ids, [0]])
    ids = np.where((edge[:-2] == 0) & (edge[2:] == 0), 0, ids)
    return ids[(ids > 0) | (np.concatenate([[0], ids[:-1]]) > 0)]


def _dense(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids numbered without gaps from 1, breaks as 0, and the id of each number."""
    known = np.unique(np.concatenate([[0], ids]))
    return np.searchsorted(known, ids), known


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes:
    """Hashes of a shard's phrases, of ``bits`` bits; they depend on the words and the language alone."""

    def __init__(self, shard: pa.Table, bits: int):
        self.lang = shard.column("lang")[0].as_py()
        words = shard.column("words").combine_chunks().flatten()
        self.words = np.concatenate([np.zeros(1, np.uint64), _word_keys(words, self.lang)])
        self.bits = np.uint64(64 - bits)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """Hashes of phrases, a row of ids each."""
        return _mixed(self.words[ids]) >> self.bits


def _word_keys(words: pa.Array, lang: str) -> np.ndarray:
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
    return own ^ np.uint64(xxhash.xxh3_64_intdigest(lang))


def _mixed(keys: np.ndarray) -> np.ndarray:
    """One number from the keys of a phrase's words, a row of them each."""
    total = np.full(len(keys), keys.shape[1], np.uint64)
    for column in keys.T:
        total = _mix(total + column)
    return total


def _text_hashes(phrases: pa.Array, lang: str, bits: int) -> np.ndarray:
    """The hashes of phrases as text, which are those of their ids."""
    split = pc.split_pattern(phrases, " ")
    words = split.flatten().dictionary_encode()
    keys = _word_keys(words.dictionary, lang)[words.indices.to_numpy()]
    starts = split.offsets.to_numpy() - split.offsets[0].as_py()
    out = np.zeros(len(phrases), np.uint64)
    for length in np.unique(np.diff(starts)):
        own = np.flatnonzero(np.diff(starts) == length)
        out[own] = _mixed(keys[starts[own][:, None] + np.arange(length)]) >> np.uint64(64 - bits)
    return out


def _packed(numbers: np.ndarray) -> bytes:
    """Rising numbers as the steps between them, byte by byte of their places."""
    steps = np.diff(numbers, prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


_ASKED = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
_ASKED_DDL = "shard long, part int, hashes binary, counts binary"
_HEARD = pa.schema([("of", pa.int64()), ("hashes", pa.binary())])


def _asked(shard: int, hashes: np.ndarray, counts: np.ndarray, bits: int, parts: int) -> list[dict]:
    """The hashes of a shard's phrases with their counts, cut by ranges of hashes."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    edges = np.searchsorted(hashes, np.array([(part << bits) // parts for part in range(1, parts)], np.uint64))
    rows = []
    for part, (own, n) in enumerate(zip(np.split(hashes, edges), np.split(counts, edges), strict=True)):
        if len(own):
            rows.append({"shard": shard, "part": part, "hashes": _packed(own), "counts": zstandard.compress(n.astype(np.int32).tobytes(), 1)})
    return rows


def _heard(min_count: int):
    """What each shard hears about a range of hashes: which of its own have a sum that suffices."""

    def run(table: pa.Table) -> pa.Table:
        hashes = [_unpacked(h) for h in table.column("hashes").to_pylist()]
        counts = [np.frombuffer(zstandard.decompress(n), np.int32) for n in table.column("counts").to_pylist()]
        every, of = np.unique(np.concatenate(hashes), return_inverse=True)
        frequent = np.bincount(of, np.concatenate(counts), len(every)) >= min_count
        left = np.split(frequent[of], np.cumsum([len(h) for h in hashes])[:-1])
        kept = [_packed(np.unique(own[stays])) for own, stays in zip(hashes, left, strict=True)]
        return pa.table([table.column("shard"), pa.array(kept, pa.binary())], schema=_HEARD)

    return run


def _frequent(heard: pa.Table) -> np.ndarray:
    found = [_unpacked(h) for h in heard.column("hashes").to_pylist()]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _among(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(hashes), bool)
    return frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes


def _word_hashes(bits: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                shard = pa.Table.from_batches([batch.slice(i, 1)])
                counts = shard.column("counts").combine_chunks().flatten().to_numpy()
                hashes = _Hashes(shard, bits).of(np.arange(1, len(counts) + 1)[:, None])
                yield pa.RecordBatch.from_pylist(_asked(shard.column("shard")[0].as_py(), hashes, counts, bits, parts), _ASKED)

    return run


def _pair_hashes(bits: int, parts: int):
    """Of the pairs of a shard's frequent words."""

    def run(shard: pa.Table, heard: pa.Table) -> pa.Table:
        if not shard.num_rows or not heard.num_rows:
            return _ASKED.empty_table()
        hashes = _Hashes(shard, bits)
        words = np.arange(len(hashes.words))
        keep = _among(hashes.of(words[:, None]), _frequent(heard))
        keep[0] = False
        tokens = _tokens(shard)
        ids, known = _dense(_without_lone_words(np.where(keep[tokens], tokens, 0)))
        rows = []
        if len(ids):
            for found, counts in PhraseIndex(ids, 2).phrases(2):
                rows += _asked(shard.column("shard")[0].as_py(), hashes.of(known[found]), counts, bits, parts)
        return pa.Table.from_pylist(rows, _ASKED)

    return run


_TEXT = -1  # the part of a row that has a shard's phrases themselves


def _phrase_hashes(bits: int, parts: int, max_words: int):
    """Of a shard's longer phrases of frequent pairs; and, for the shard alone, frequent words and all phrases of frequent pairs as text."""

    def run(shard: pa.Table, heard: pa.Table) -> pa.Table:
        if not shard.num_rows or not heard.num_rows:
            return _ASKED.empty_table()
        hashes, frequent = _Hashes(shard, bits), _frequent(heard)
        number, words = shard.column("shard")[0].as_py(), shard.column("words").combine_chunks().flatten()
        tokens = _tokens(shard)
        linked = _among(hashes.of(np.stack([tokens[:-1], tokens[1:]], axis=1)), frequent) & (tokens[:-1] > 0) & (tokens[1:] > 0)
        listed = np.arange(1, len(hashes.words))[_among(hashes.of(np.arange(1, len(hashes.words))[:, None]), frequent)]
        ids, known = _dense(_without_lone_words(np.insert(tokens, np.flatnonzero(~linked) + 1, 0)))
        counts_of = shard.column("counts").combine_chunks().flatten().to_numpy()
        found = [(listed[:, None], counts_of[listed - 1])]
        if len(ids):
            found += [(known[phrases], counts) for phrases, counts in PhraseIndex(ids, max_words).phrases(max_words)]
        columns = [
            pa.concat_arrays([_joined(words, phrases) for phrases, _ in found]),
            pa.array(np.concatenate([counts for _, counts in found])),
        ]
        listed = pa.table(columns, ["phrase", "n"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, listed.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(listed)
        longer = [(hashes.of(phrases), counts) for phrases, counts in found if phrases.shape[1] > 2]
        asked = _asked(number, *(np.concatenate(column) for column in zip(*longer)), bits, parts) if longer else []
        own = {"shard": number, "part": _TEXT, "hashes": sink.getvalue().to_pybytes(), "counts": hashes.lang.encode("utf-8", "surrogatepass")}
        return pa.Table.from_pylist([own, *asked], _ASKED)

    return run


_TEXTS = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("phrases", pa.binary()), ("counts", pa.binary())])
_COUNTED = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])


def _texts(bits: int, parts: int):
    """The phrases of a shard that may be frequent, by ranges of hashes, a line each: no word has a line break."""

    def run(listed: pa.Table, heard: pa.Table) -> pa.Table:
        if not listed.num_rows:
            return _TEXTS.empty_table()
        lang = listed.column("counts")[0].as_py().decode("utf-8", "surrogatepass")
        found = pa.ipc.open_stream(listed.column("hashes")[0].as_py()).read_all()
        every = found.column("phrase").combine_chunks()
        key = _text_hashes(every, lang, bits)
        # words and pairs were found to be frequent before
        stays = np.flatnonzero((pc.count_substring(every, " ").to_numpy() < 2) | _among(key, _frequent(heard)))
        stays = stays[np.argsort(key[stays], kind="stable")]
        key, phrases, n = key[stays], every.take(pa.array(stays)).to_pylist(), found.column("n").to_numpy()[stays]
        edges = np.searchsorted(key, np.array([(part << bits) // parts for part in range(1, parts)], np.uint64)).tolist()
        rows = []
        for part, (a, b) in enumerate(zip([0, *edges], [*edges, len(key)])):
            if b > a:
                order = sorted(range(a, b), key=phrases.__getitem__)  # alike phrases side by side take less room
                text = "\n".join([phrases[i] for i in order]).encode("utf-8", "surrogatepass")
                rows.append({"part": part, "lang": lang, "phrases": zstandard.compress(text, 3), "counts": zstandard.compress(n[order].tobytes(), 3)})
        return pa.Table.from_pylist(rows, _TEXTS)

    return run


def _summed(min_count: int):
    """The exact counts of the phrases in a range of hashes."""

    def run(table: pa.Table) -> pa.Table:
        langs, phrases, counts = [], [], []
        for row in table.to_pylist():
            own = zstandard.decompress(row["phrases"]).decode("utf-8", "surrogatepass").split("\n")
            langs += [row["lang"]] * len(own)
            phrases += own
            counts.append(np.frombuffer(zstandard.decompress(row["counts"]), np.int64))
        every = pa.table([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(np.concatenate(counts))], ["lang", "phrase", "n"])
        sums = every.group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("n_sum"), min_count))
        length = pc.add(pc.count_substring(sums.column("phrase"), " "), 1).cast(pa.int32())
        return pa.table([sums.column("lang"), length, sums.column("phrase"), sums.column("n_sum")], schema=_COUNTED)

    return run


def _joined(words: pa.Array, ids: np.ndarray) -> pa.Array:
    """Phrases as text; ids count the shard's words from 1."""
    columns = [words.take(pa.array(column - 1)) for column in ids.T]
    return pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, DataFrame]:
    """(lang, length, phrase, n) of all phrases of 1 to ``max_words`` words that occur ``min_count`` times, and (lang, total) words.

    Null texts are empty, a null language is ``und``. Rows repeated or without words, other columns and an empty table need no care:
    every row's text counts.
    """
    named = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    schema = "lang string, tokens binary, words array<string>, counts array<long>"
    shards = staged(named.mapInArrow(_sharded(shard_words), schema).withColumn("shard", F.monotonically_increasing_id()), "shards")
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = staged(shards.groupBy("lang").agg(F.sum(size).alias("total")).where("total > 0"), "totals")
    total = totals.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()["n"]
    # few phrases share a hash, whatever the corpus; a task sums up the hashes of some million words
    bits = min(63, 8 + max(1, int(total)).bit_length())
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_WORDS))

    def ask(rows: DataFrame) -> DataFrame:
        return rows.groupBy("part").applyInArrow(_heard(min_count), "of long, hashes binary")

    def with_index(heard: DataFrame, run) -> DataFrame:
        index = shards.select("shard", "lang", "tokens", "words", "counts")
        return index.groupBy("shard").cogroup(heard.groupBy("of")).applyInArrow(run, _ASKED_DDL)

    words = staged(ask(shards.select("shard", "lang", "words", "counts").mapInArrow(_word_hashes(bits, parts), _ASKED_DDL)), "words")
    pairs = ask(with_index(words, _pair_hashes(bits, parts)))
    longer = staged(with_index(words.unionByName(pairs), _phrase_hashes(bits, parts, max_words)), "phrases")
    heard = ask(longer.where(F.col("part") != _TEXT))
    listed = longer.where(F.col("part") == _TEXT).select("shard", "hashes", "counts")
    texts = listed.groupBy("shard").cogroup(heard.groupBy("of")).applyInArrow(
        _texts(bits, parts), "part int, lang string, phrases binary, counts binary"
    )
    counts = texts.groupBy("part").applyInArrow(_summed(min_count), "lang string, length int, phrase string, n long")
    counts = staged(counts, "counts")
    for spent in (shards, words, longer):
        drop_staged(docs.sparkSession, spent)
    return counts, totals


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    cover_percent: int = 100,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, most_left, most_right): the ``top`` phrases of every language by score.

    ``a`` counts the phrase, ``n`` all words of the language; ``l`` and ``r`` count the parts of the cut of the lowest score,
    floor(1000 * a * n / (l * r)), the first of equal ones. Phrases that an extension has in ``cover_percent`` of their places are dropped;
    ``most_left`` and ``most_right`` count the most frequent extension to either side, as far as it is frequent (else 0).
    """
    counts, totals = phrase_counts(docs, text, lang, max_words, min_count, shard_words)
    words = F.split("phrase", " ", -1)
    size = F.col("length")
    longer = counts.where("length > 2")
    sides = longer.select(
        "lang",
        "n",
        F.explode(
            F.array(
                F.struct(F.lit("right").alias("side"), F.array_join(F.slice(words, 1, size - 1), " ").alias("inner")),
                F.struct(F.lit("left").alias("side"), F.array_join(F.slice(words, 2, size - 1), " ").alias("inner")),
            )
        ).alias("part"),
    )
    most = sides.groupBy("lang", F.col("part.inner").alias("phrase")).agg(
        F.max(F.when(F.col("part.side") == "left", F.col("n"))).alias("most_left"),
        F.max(F.when(F.col("part.side") == "right", F.col("n"))).alias("most_right"),
    )
    found = counts.where("length > 1").withColumnRenamed("n", "a").join(most, ["lang", "phrase"], "left")
    found = found.fillna(0, ["most_left", "most_right"])
    found = staged(found.where(F.greatest("most_left", "most_right") * 100 < F.col("a") * cover_percent), "found")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns(
        {"head": F.array_join(F.slice(words, 1, F.col("k")), " "), "tail": F.array_join(F.slice(words, F.col("k") + 1, size), " ")}
    )
    part = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    scored = cuts.join(part.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"])
    scored = scored.join(part.withColumnsRenamed({"part": "tail", "f": "r"}), ["lang", "tail"]).join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "total", "l", "r")}
    scored = scored.withColumn("above", F.lit(1000).cast("decimal(4,0)") * (wide["a"] * wide["total"]).cast("decimal(34,0)"))
    scored = scored.withColumn("below", (wide["l"] * wide["r"]).cast("decimal(38,0)"))
    scored = scored.withColumn("score", F.expr("above div below").cast("long"))
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
        *[F.first(c).alias(c) for c in ("a", "total", "most_left", "most_right")],
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score", "most_left", "most_right"
    )
