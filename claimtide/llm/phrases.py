"""Phrase collocation mining with stripes: each prefix keys an associative counter of the words that follow it.

A stripe holds how often its prefix occurs and, per next word, how often that word follows.  Stripes of one prefix merge
elementwise, so tasks gather them over their texts and pass them on whenever they hold many.  The merged stripes give all
that the scores need: the extensions of a prefix are the longer phrases, its total is the first part of their cuts, and
its greatest entry is the largest phrase that goes on from it.

The texts are read once for each length of prefix, from the empty one, whose stripe counts all words, to three words.  No
phrase is more frequent than its parts, so a prefix, and a word behind it, are only counted where all shorter phrases in
them reach the least count.  Tasks know these by a bitmap of hashes that Spark makes from the merged stripes one word
shorter: about 16 bits a phrase and never more than 2 ** ``MOST_BITS``.  A bit too many only means counting in vain.

A very frequent prefix is striped in parts, by a hash of the next word, as many as its known count asks for; its total
goes with the first part.  Stripes travel in blocks, one for all of a task's stripes whose hashes share a bucket; there
are as many buckets as the number of words asks for, so that a bucket's stripes can be merged at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimtide.llm.common import LOWER, staged

LONGEST = 4
LEAST = 30
KEPT = 2000
# A candidate goes if a longer one has at least COVERED of 100 of its occurrences.
COVERED = 80
SCALE = 2_000_000
UNKNOWN = "und"
# Distinct phrases that a task gathers, and words that it remembers.
GATHERED, REMEMBERED = 4_000_000, 400_000
# Words that are looked at together; numbers of a language's frequent words have 16 bits, so that four fit a code.
AT_ONCE, NUMBERS = 50_000, 1 << 16
# Codes of phrases that wait to be added up.
WAITING = 4_000_000
# Sizes of the bitmaps, as powers of two; Spark makes them in pieces of 2 ** 15 bits.
LEAST_BITS, MOST_BITS, PIECE_BITS = 16, 29, 15
# Parts of the empty prefix.  Others have one for each so many occurrences; those that have more than one are known to
# all tasks, the most frequent ``MOST_HOT`` of them.
FIRST_PARTS, PART_ROWS, MOST_PARTS, MOST_HOT = 256, 200_000, 1024, 65_536
# Words of the texts for each bucket of stripes, the fewest buckets, and stripes and entries that a merge holds.
BUCKET_WORDS, LEAST_BUCKETS, HELD = 500_000, 64, 2_000_000
# Buckets that choose the first phrases of a language before one task does.
BUCKETS = 16

# Bytes that end a piece become full stops, tabs become spaces, A-Z are lower-cased.
PIECES = bytes(46 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else LOWER[b] for b in range(256))
# Fixed odd multipliers that mix hashes of adjacent words.
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_and_stops(text: bytes | None) -> list[bytes]:
    """Lower-cased words, with a full stop, which is in no word, where a piece ends."""
    return text.translate(PIECES).replace(b".", b" . ").split() if text else []


def seed_of(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


class Words(dict):
    """Number and hash of every word of a language; 0 is the end of a piece."""

    def __init__(self, lang: str):
        super().__init__({b".": 0})
        self.lang, self.seed = lang, seed_of(lang)
        self.all, self.digests, self.hashes = [b"."], [0], np.zeros(1, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.all)
        self.all.append(word)
        self.digests.append(xxhash.xxh64_intdigest(word, self.seed) | 1)
        return number

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Numbers of the words, and for phrases of 1 to ``LONGEST`` words the hash of the one at each place."""
        numbers = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.digests) > len(self.hashes):
            self.hashes = np.append(self.hashes, np.array(self.digests[len(self.hashes):], dtype=np.uint64))
        return numbers, list(phrase_hashes(self.hashes[numbers]))


class Lexicon:
    """Words by language; forgets all when it holds many."""

    def __init__(self):
        self.known: dict[str, Words] = {}

    def full(self) -> bool:
        return sum(map(len, self.known.values())) > REMEMBERED

    def of(self, lang: str) -> Words:
        if lang not in self.known:
            self.known[lang] = Words(lang)
        return self.known[lang]


def joined(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of its beginning and that of its last word."""
    mixed = (before * FIRST) ^ (last * SECOND)
    return (mixed ^ (mixed >> np.uint64(29))) | np.uint64(1)


def phrase_hashes(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """For phrases of 1 to ``LONGEST`` words the hash of the one at each place; 0 where a piece ends first."""
    own = hashes
    yield own
    for n in range(1, LONGEST):
        longer = np.zeros_like(hashes)
        if len(hashes) > n:
            before, last = own[:-n], hashes[n:]
            longer[:-n] = np.where((before != 0) & (last != 0), joined(before, last), 0)
        own = longer
        yield own


def hash_of(lang: str, phrase: bytes) -> int:
    """The hash that ``phrase_hashes`` gives to a phrase."""
    own, seed = None, seed_of(lang)
    for word in phrase.split(b" "):
        one = np.array([xxhash.xxh64_intdigest(word, seed) | 1], dtype=np.uint64)
        own = one if own is None else joined(own, one)
    return int(own[0])


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes * FIRST) >> np.uint64(64 - bits)).astype(np.int64)


class Sieve:
    """What tasks know of the phrases counted so far: per length a bitmap, and the parts of very frequent prefixes."""

    def __init__(self, levels: list[tuple[int, np.ndarray]] = (), hot: dict[int, int] | None = None):
        self.levels = list(levels)
        some = sorted((hot or {}).items())
        self.hot, self.parts = np.array([h for h, _ in some], dtype=np.uint64), np.array([p for _, p in some], dtype=np.int64)

    def passes(self, hashes: list[np.ndarray]) -> list[np.ndarray]:
        """Whether the phrase of 1 to ``LONGEST`` words at each place may be frequent, as all its parts may."""
        found: list[np.ndarray] = []
        for n, own in enumerate(hashes):
            ok = own != 0
            if n:
                ok[:-1] &= found[-1][:-1] & found[-1][1:]
            if n < len(self.levels):
                bits, level = self.levels[n]
                at = places(own[ok], bits)
                ok[ok] = (level[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            found.append(ok)
        return found

    def parts_of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=np.int64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, hashes), len(self.hot) - 1)
            known = self.hot[at] == hashes
            out[known] = self.parts[at[known]]
        return out


def words_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], int]]:
    """Words and stops of many texts of a language at once; ``batches`` have ``lang, text``, the text in bytes.

    The last number tells how many places begin phrases: the words behind them only end phrases, and come again.
    """
    def parts(lang: str, words: list[bytes]) -> Iterator[tuple[str, list[bytes], int]]:
        for start in range(0, len(words), AT_ONCE):
            part = words[start:start + AT_ONCE + LONGEST - 1]
            yield lang, part, min(AT_ONCE, len(words) - start)

    for batch in batches:
        ready: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = ready.setdefault(lang, [])
            own += words_and_stops(text.as_py())
            own.append(b".")
            if len(own) > AT_ONCE:
                yield from parts(lang, ready.pop(lang))
        for lang, own in ready.items():
            yield from parts(lang, own)


def added_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with the sums of their counts."""
    every, number = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, number = every[order], number[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, dtype=np.int64)
    return every[first], np.add.reduceat(number, first) if len(first) else number


STRIPES = "lang string, prefix binary, size int, part int, total long, nexts array<binary>, counts array<long>"
NAMES = ["lang", "prefix", "size", "part", "total", "nexts", "counts"]
KINDS = [pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())]


SCHEMA = pa.schema(list(zip(NAMES, KINDS)))


def stripes(lang: str, size: int, prefixes: pa.Array, digests: np.ndarray, totals: np.ndarray, of: np.ndarray,
            part: np.ndarray, nexts: pa.Array, counts: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
    """Stripes of distinct ``prefixes`` and their hashes; entry i belongs to ``part[i]`` of the prefix ``of[i]``."""
    key = of * MOST_PARTS + part
    order = np.argsort(key, kind="stable")
    key = key[order]
    rows = np.union1d(np.arange(len(prefixes), dtype=np.int64) * MOST_PARTS, key)
    ends = pa.array(np.append(0, np.searchsorted(key, rows, side="right")).astype(np.int32))
    at, own = rows // MOST_PARTS, rows % MOST_PARTS
    whole = pa.RecordBatch.from_arrays(
        [pa.repeat(lang, len(rows)), prefixes.take(pa.array(at)), pa.array(np.full(len(rows), size, dtype=np.int32)),
         pa.array(own.astype(np.int32)), pa.array(np.where(own == 0, totals[at], 0)),
         pa.ListArray.from_arrays(ends, nexts.take(pa.array(order))), pa.ListArray.from_arrays(ends, pa.array(counts[order]))],
        schema=SCHEMA)
    return whole, joined(digests[at], own.astype(np.uint64) + np.uint64(1))


def blocks(whole: pa.RecordBatch, hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """``bucket, block``: the stripes of each bucket as one value."""
    bucket = ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    whole, bucket = whole.take(pa.array(order)), bucket[order]
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, dtype=np.int64)
    ends = np.append(starts[1:], len(bucket))
    packed = [whole.slice(i, j - i).serialize().to_pybytes() for i, j in zip(starts.tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array(packed, pa.binary())], names=["bucket", "block"])


def unpacked(block: bytes) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(block), SCHEMA)


class GatheredWords:
    """Words of one language that a task has counted: the stripe of the empty prefix."""

    def __init__(self, words: Words):
        self.words, self.counts = words, np.zeros(0, dtype=np.int64)

    def add(self, numbers: np.ndarray, hashes: list[np.ndarray], sieve: Sieve, starts: int) -> bool:
        found = np.bincount(numbers[:starts], minlength=len(self.words.all))
        found[:len(self.counts)] += self.counts
        self.counts = found
        return True

    def settle(self) -> int:
        return len(self.counts)

    def stripes(self, sieve: Sieve) -> tuple[pa.RecordBatch, np.ndarray]:
        some = np.flatnonzero(self.counts[1:]) + 1
        nexts = pa.array(self.words.all, pa.binary()).take(pa.array(some))
        part = ((self.words.hashes[some] >> np.uint64(32)) % np.uint64(FIRST_PARTS)).astype(np.int64)
        return stripes(self.words.lang, 0, pa.array([b""], pa.binary()), np.ones(1, dtype=np.uint64),
                       np.array([self.counts[1:].sum()]), np.zeros(len(some), dtype=np.int64), part, nexts, self.counts[some])


class Gathered:
    """Prefixes of ``size`` words of one language and what follows them, as codes of the numbers of their words."""

    def __init__(self, words: Words, size: int):
        self.words, self.size = words, size
        # Numbers of 16 bits for words that may be frequent: by the word's own number, and back.
        self.short, self.long = np.zeros(0, dtype=np.uint64), [0]
        self.codes: list[list[np.ndarray]] = [[], []]
        self.counts: list[list[np.ndarray]] = [[], []]
        self.waiting = 0

    def _room_for(self, numbers: np.ndarray) -> bool:
        """Numbers the words, unless there are too many of them."""
        if len(self.words.all) > len(self.short):
            self.short = np.append(self.short, np.zeros(len(self.words.all) - len(self.short), dtype=np.uint64))
        seen = np.unique(numbers)
        new = seen[self.short[seen] == 0]
        if len(self.long) + len(new) > NUMBERS:
            return False
        self.short[new] = np.arange(len(self.long), len(self.long) + len(new), dtype=np.uint64)
        self.long += new.tolist()
        return True

    def add(self, numbers: np.ndarray, hashes: list[np.ndarray], sieve: Sieve, starts: int) -> bool:
        """Count the phrases that begin at the first ``starts`` places; False if their words have no room here."""
        passes = sieve.passes(hashes)
        if not self._room_for(numbers[passes[0]]):
            return False
        short = self.short[numbers]
        code = short
        for n in range(1, self.size + 2):
            if n > 1:
                code = (code[:-1] << np.uint64(16)) | short[n - 1:]
            if n >= self.size:
                found, count = np.unique(code[:starts][passes[n - 1][:len(code)][:starts]], return_counts=True)
                self.codes[n - self.size].append(found)
                self.counts[n - self.size].append(count)
                self.waiting += len(found)
        if self.waiting > WAITING:
            self.settle()
        return True

    def settle(self) -> int:
        """Number of distinct phrases."""
        for n in range(2):
            if len(self.codes[n]) > 1:
                codes, counts = added_up(self.codes[n], self.counts[n])
                self.codes[n], self.counts[n] = [codes], [counts]
        self.waiting = 0
        return sum(len(c) for codes in self.codes for c in codes)

    def stripes(self, sieve: Sieve) -> tuple[pa.RecordBatch, np.ndarray]:
        self.settle()
        (codes, longer), (totals, counts) = ([x[0] for x in both] for both in (self.codes, self.counts))
        long = np.array(self.long, dtype=np.int64)
        word = pa.array(self.words.all, pa.binary()).take(pa.array(long))
        digest, mask = self.words.hashes[long], np.uint64(NUMBERS - 1)
        own, prefix = None, []
        for k in range(self.size - 1, -1, -1):
            at = ((codes >> np.uint64(16 * k)) & mask).astype(np.int64)
            own = digest[at] if own is None else joined(own, digest[at])
            prefix.append(word.take(pa.array(at)))
        prefixes = prefix[0] if self.size == 1 else pc.binary_join_element_wise(*prefix, b" ")
        last = (longer & mask).astype(np.int64)
        of = np.searchsorted(codes, longer >> np.uint64(16))
        part = ((digest[last] >> np.uint64(32)) % sieve.parts_of(own)[of].astype(np.uint64)).astype(np.int64)
        return stripes(self.words.lang, self.size, prefixes, own, totals, of, part, word.take(pa.array(last)), counts)


def gathered_stripes(texts: DataFrame, sieve: Sieve, size: int, buckets: int, gathered: int = GATHERED) -> DataFrame:
    """Stripes of all prefixes of ``size`` words from all tasks, as ``bucket, block``; a prefix may be in many blocks.

    The bytes of a prefix have a space between words.
    """
    shared = texts.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, lexicon, held = shared.value, Lexicon(), {}

        def new(lang: str) -> GatheredWords | Gathered:
            return Gathered(lexicon.of(lang), size) if size else GatheredWords(lexicon.of(lang))

        for lang, words, starts in words_by_language(batches):
            if lexicon.full() or (sum(getattr(g, "waiting", 0) for g in held.values()) > gathered
                                  and sum(g.settle() for g in held.values()) > gathered):
                for own in held.values():
                    yield blocks(*own.stripes(sieve), buckets)
                lexicon, held = Lexicon(), {}
            numbers, hashes = lexicon.of(lang).look_up(words)
            own = held.setdefault(lang, None) or new(lang)
            if not own.add(numbers, hashes, sieve, starts):
                if own.codes[0]:
                    yield blocks(*own.stripes(sieve), buckets)
                own = new(lang)
                own.add(numbers, hashes, sieve, starts)
            held[lang] = own
        for own in held.values():
            yield blocks(*own.stripes(sieve), buckets)

    return texts.mapInArrow(run, "bucket long, block binary")


def merge_rows(table: pa.Table, least: int) -> pa.RecordBatch:
    """One row for each prefix and part: totals and counters added up elementwise, entries below ``least`` left out."""
    table = table.sort_by([(c, "ascending") for c in NAMES[:4]])
    columns = [pa.concat_arrays(c.chunks) for c in table.columns]
    *keys, total, nexts, counts = columns
    change = np.ones(table.num_rows, dtype=bool)
    change[1:] = False
    for c in keys:
        change[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
    starts, run = np.flatnonzero(change), np.cumsum(change) - 1
    words = nexts.flatten().dictionary_encode()
    width = max(1, len(words.dictionary))
    entry = np.repeat(run, pc.list_value_length(nexts).to_numpy()) * width + words.indices.to_numpy()
    codes, sums = added_up([entry], [counts.flatten().to_numpy()])
    kept = sums >= least
    codes, sums = codes[kept], sums[kept]
    ends = pa.array(np.searchsorted(codes // width, np.arange(len(starts) + 1)).astype(np.int32))
    first = pa.array(starts)
    return pa.RecordBatch.from_arrays(
        [*[c.take(first) for c in keys], pa.array(np.add.reduceat(total.to_numpy(), starts)),
         pa.ListArray.from_arrays(ends, words.dictionary.take(pa.array(codes % width))),
         pa.ListArray.from_arrays(ends, pa.array(sums))], schema=SCHEMA)


def merged_stripes(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per language, prefix and part of ``bucket, block`` rows: totals and counters added up elementwise.

    Entries below ``least`` are left out, and so are stripes whose total is, without entries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = None, [], 0

        def merged(floor: int) -> pa.RecordBatch:
            return merge_rows(pa.Table.from_batches(held), floor)

        def finished() -> pa.RecordBatch:
            whole = merged(least)
            some = pc.or_(pc.greater_equal(whole.column(4), pc.if_else(pc.equal(whole.column(2), 0), 1, least)),
                          pc.greater(pc.list_value_length(whole.column(5)), 0))
            return whole.filter(some)

        for batch in batches:
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != at and held:
                    yield finished()
                    held, size = [], 0
                at = bucket
                held.append(unpacked(block.as_py()))
                size += held[-1].num_rows + len(held[-1].column(6).flatten())
                if size > HELD:
                    held = [merged(0)]
                    size = held[0].num_rows  # its entries can't be added up any further
        if held:
            yield finished()

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, STRIPES)


def bitmap_of(phrases: DataFrame) -> tuple[int, np.ndarray]:
    """Bits and bitmap of the hashes of ``lang, phrase``; what reaches the driver has a fixed size at most."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * phrases.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hash_of(lang, phrase) for lang, phrase in zip(*[c.to_pylist() for c in batch.columns])]
            yield pa.RecordBatch.from_arrays([pa.array(places(np.array(found, dtype=np.uint64), bits))], names=["place"])

    place = phrases.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(run, "place long")
    pieces = place.groupBy(F.shiftright("place", PIECE_BITS).alias("piece")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << PIECE_BITS) - 1))).alias("bits"))
    bitmap = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for row in pieces.toLocalIterator():
        start = row.piece << (PIECE_BITS - 3)
        bitmap[start:start + (1 << (PIECE_BITS - 3))] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return bits, bitmap


def hot_prefixes(phrases: DataFrame) -> dict[int, int]:
    """Parts of the prefixes ``lang, phrase, a`` that occur more than ``PART_ROWS`` times, by hash."""
    rows = phrases.filter(F.col("a") > PART_ROWS).orderBy(F.desc("a"), "lang", "phrase").limit(MOST_HOT)
    return {hash_of(r.lang, r.phrase.encode("utf-8", "surrogatepass")): min(MOST_PARTS, 1 << (r.a // PART_ROWS).bit_length())
            for r in rows.select("lang", "phrase", "a").collect()}


def phrase_counts(merged: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Totals ``lang, prefix, size, f, onward`` of prefixes, and their extensions ``lang, prefix, word, phrase, size, a``.

    ``onward`` is the greatest count among the extensions of a prefix.
    """
    told = merged.select("lang", F.col("prefix").cast("string").alias("prefix"), "size", "total", "nexts", "counts")
    greatest = F.coalesce(F.array_max("counts"), F.lit(0).cast("long"))
    totals = told.groupBy("lang", "prefix", "size").agg(F.sum("total").alias("f"), F.max(greatest).alias("onward"))
    entries = told.select("lang", "prefix", (F.col("size") + 1).alias("size"),
                                             F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
    word = F.col("e.nexts").cast("string")
    text = F.when(F.col("size") == 1, word).otherwise(F.concat_ws(" ", "prefix", word))
    phrases = entries.select("lang", "prefix", word.alias("word"), text.alias("phrase"), "size", F.col("e.counts").alias("a"))
    return totals.filter((F.col("f") >= least) | (F.col("size") == 0)), phrases.filter(F.col("a") >= least)


def _wide(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def score_phrases(merged: DataFrame, least: int = LEAST, covered: int = COVERED, scale: int = SCALE) -> DataFrame:
    """``lang, phrase, size, a, l, r, score`` of every candidate that no longer one covers, from ``merged_stripes``."""
    totals, phrases = phrase_counts(merged, least)
    totals, phrases = staged(totals), staged(phrases)
    # Counts of a phrase's beginnings and of its ends, shortest first, from those of phrases one word shorter.
    shorter = totals.filter("size = 1").select("lang", F.col("prefix").alias("phrase"), F.array("f").alias("heads"),
                                               F.array("f").alias("tails"))
    levels = []
    for size in range(2, LONGEST + 1):
        own = phrases.filter(F.col("size") == size).withColumn("rest", F.expr("substr(phrase, locate(' ', phrase) + 1)"))
        heads = shorter.select("lang", F.col("phrase").alias("prefix"), "heads")
        tails = shorter.select("lang", F.col("phrase").alias("rest"), "tails")
        shorter = staged(own.join(heads, ["lang", "prefix"]).join(tails, ["lang", "rest"]).select(
            "lang", "phrase", "rest", "size", "a", F.concat("heads", F.array("a")).alias("heads"),
            F.concat("tails", F.array("a")).alias("tails")))
        levels.append(shorter)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    # The greatest phrase one word longer, to the right and to the left; still longer ones don't occur more often.
    right = totals.filter("size > 1").select("lang", F.col("prefix").alias("phrase"), "onward")
    left = every.filter("size > 2").groupBy("lang", F.col("rest").alias("phrase")).agg(F.max("a").alias("backward"))
    zero = F.lit(0).cast("long")
    longer = F.greatest(F.coalesce("onward", zero), F.coalesce("backward", zero))
    free = every.join(right, ["lang", "phrase"], "left").join(left, ["lang", "phrase"], "left").filter(
        _wide(longer) * 100 < _wide(F.col("a")) * covered)
    cuts = []
    for cut in range(1, LONGEST):
        first, last = F.get("heads", F.lit(cut - 1)), F.get("tails", F.col("size") - (cut + 1))
        # Decimals hold the product, and ``div`` on them is exact.
        score = F.call_function("div", _wide(F.col("a")) * scale, _wide(first) + _wide(last)).cast("long")
        cuts.append(F.when(F.col("size") > cut, F.struct(score.alias("score"), F.lit(cut).alias("cut"), first.alias("l"),
                                                         last.alias("r"))))
    return free.select("lang", "phrase", "size", "a", F.least(*cuts).alias("best")).select(
        "lang", "phrase", "size", "a", "best.l", "best.r", "best.score")


def first_phrases(scored: DataFrame, kept: int = KEPT, buckets: int = BUCKETS) -> DataFrame:
    """The first ``kept`` phrases of each language, ``rank`` from 1: by score, count and phrase."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = scored.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).filter(
        F.col("rank") <= kept)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= kept).drop("bucket")


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, covered: int = COVERED,
                 kept: int = KEPT, gathered: int = GATHERED) -> DataFrame:
    """``lang, rank, phrase, size, a, l, r, n, score`` of the first ``kept`` collocations of each language.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces, and those into words at spaces and tabs.  A
    candidate has 2 to 4 words of one piece and ``a >= least`` occurrences, overlaps counted.  Its score is the least over
    its cuts of floor(SCALE * a / (l + r)), ``l`` and ``r`` the counts of both parts; of equal ones the first cut counts.
    ``n`` is the number of all words of the language.

    A NULL language is ``und``, a NULL text empty.  Repeated rows count each.  Languages without words, and empty tables,
    have no rows; other columns are ignored.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"),
                        F.col(f"`{text}`").cast("binary").alias("text")).filter(F.length("text") > 0)
    levels, hot, parts, buckets = [], {}, [], FIRST_PARTS
    for size in range(LONGEST):
        parts.append(staged(merged_stripes(gathered_stripes(texts, Sieve(levels, hot), size, buckets, gathered), least)))
        if not size:
            words = staged(parts[0].groupBy("lang").agg(F.sum("total").alias("n")))
            total = words.agg(F.sum("n").alias("n")).first().n or 0
            buckets = max(LEAST_BUCKETS, total // BUCKET_WORDS)
        if size < LONGEST - 1:
            longer = staged(phrase_counts(parts[-1], least)[1].select("lang", "phrase", "a"))
            levels, hot = [*levels, bitmap_of(longer)], hot_prefixes(longer)
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return first_phrases(score_phrases(merged, least, covered), kept).join(words, "lang")
