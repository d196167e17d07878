"""Collocations from an FM-index per shard over word ids.

Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces, pieces at blanks and
tabs into words. A shard holds up to 16 MB of the texts of one language that a task reads; no text
is shuffled for it. Words that are frequent enough in the whole language get an id; a shard's text
becomes symbols, 1 to m in the order of the ids, and 0 for piece ends and all other words, which no
frequent phrase can hold.

A shard is indexed by its Burrows-Wheeler transform in both directions, sorted to the depth asked
for. Each frequent phrase of k - 1 words is an interval of rows, found by backward search; phrases
of k words are its extensions, to the left in the forward transform where k is even, to the right
in the backward one where it is odd. All are read off at once: the LF mapping leads each row to the
row one word on, and a run of rows with the same interval of their own (one side) and behind the
mapping (the other side) is one phrase, its length the count. Counts are summed across shards; what
reaches the minimum returns to the shards that hold it, and the next depth extends only that. So
nothing is enumerated whose two parts are not frequent everywhere, and no table of all n-grams of a
depth beyond is made.

A phrase is known by the ids of its two parts (all but the last word, all but the first), so a
shard names what it counts by two numbers. They travel as sorted, compressed blocks, one for each
bucket of names, and a task adds up a bucket: of a phrase it meets at most one count a shard. The
counts of all cuts follow from the parts, level by level, as does what is held in a longer phrase: a
longer phrase of at least 80 % of its count holds it exactly if one longer by one word does.

Rows are folded by shard before any shuffle; a word in a third of all places is one row a shard.
Counts are exact, products are decimals. Defined results: null texts are empty, null languages are
``und`` and so share its counts; a phrase does not cross pieces, documents or shards of a text, as
texts are cut between pieces only; one piece has to fit a task; repeated rows count each time; an
empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import batches, bounded, land, table, tasks_for
from pageloom.runtime import quoted

#: What ends a piece; blanks and tabs end words.
ENDS = ".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
#: Bytes of text of a shard, and tokens of the shards that a task works on, about.
SHARD_BYTES = 16 << 20
TASK_TOKENS = 3_000_000
#: Counts of phrases, from all shards, that one task adds up, about.
BUCKET_TOKENS = 3_000_000
LONGEST, LEAST, FIRST = 4, 30, 2000
#: Share of a phrase's count from which a longer one stands for it, in hundredths.
COVERED = 80
#: Score of a phrase whose parts never stand apart.
HIGHEST = 2_000_000


def tokens(raw: bytes) -> pa.Array:
    """The words of a text in order, each piece end as a line end."""
    same = bytearray(bytes(range(256)).lower())
    for c in ENDS.encode():
        same[c] = 10
    same[9] = 32
    spaced = raw.translate(bytes(same)).replace(b"\n", b" \n ")
    found = pc.split_pattern(pa.array([spaced], pa.large_binary()), pattern=b" ").flatten()
    return found.filter(pc.greater(pc.binary_length(found), 0))


def cut_long(raw: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes that end where a piece ends."""
    at = 0
    ends = [c.encode() for c in ENDS]
    while len(raw) - at > size:
        cut = max(raw.rfind(c, at, at + size) for c in ends)
        if cut < at:  # one piece longer than a part
            later = [p for p in (raw.find(c, at + size) for c in ends) if p >= 0]
            cut = min(later, default=len(raw) - 1)
        yield raw[at : cut + 1]
        at = cut + 1
    if at < len(raw):
        yield raw[at:]


def packed(numbers: np.ndarray) -> bytes:
    """Compressed by planes of bytes: the upper ones are nearly all alike."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw, width * n, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def without_runs(text: np.ndarray) -> np.ndarray:
    """Of several ends of pieces in a row, one tells enough."""
    return text[np.append(True, (text[1:] != 0) | (text[:-1] != 0))] if len(text) else text


def shards(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(shard, lang, words, counts, n, text): words by falling counts; text holds n numbers, 0 for a
    piece end, i + 1 for words[i]."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 33
        held, sizes, total = {}, {}, 0

        def out(lang: str) -> pa.RecordBatch | None:
            nonlocal shard, total
            coded = tokens(b"\n".join(held.pop(lang))).dictionary_encode()
            total -= sizes.pop(lang)
            ids, words = coded.indices.to_numpy(), coded.dictionary
            counts = np.bincount(ids, minlength=len(words))
            end = pc.index(words, pa.scalar(b"\n", pa.large_binary())).as_py()
            if end >= 0:
                counts[end] = 0
            order = np.argsort(-counts, kind="stable")
            order = order[order != end]
            names = np.zeros(len(words), np.int32)
            names[order] = np.arange(1, len(order) + 1)
            words, counts = words.take(pa.array(order)), counts[order]
            text = without_runs(names[ids])
            if not len(words):
                return None
            lists = [pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), v) for v in (words.cast(pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()))]
            row = [pa.array([shard], pa.int64()), pa.array([lang], pa.string()), *lists, pa.array([len(text)], pa.int64()), pa.array([packed(text)], pa.binary())]
            shard += 1
            return pa.RecordBatch.from_arrays(row, names=["shard", "lang", "words", "counts", "n", "text"])

        for batch in batches(source, 256):
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                for part in cut_long(raw or b"", SHARD_BYTES):
                    if held and total + len(part) > SHARD_BYTES:
                        made = out(max(sizes, key=sizes.get))
                        if made is not None:
                            yield made
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part)
                    total += len(part)
        for lang in list(held):
            made = out(lang)
            if made is not None:
                yield made

    rows = docs.select(F.coalesce(F.col(quoted(lang_col)), F.lit(UNKNOWN)).alias("lang"), F.col(quoted(text_col)).alias("text"))
    return rows.mapInArrow(run, "shard long, lang string, words array<string>, counts array<long>, n long, text binary")


class Index:
    """Burrows-Wheeler transform of a text over symbols 1..m (0 ends pieces), by the first ``depth`` symbols of each row."""

    def __init__(self, text: np.ndarray, depth: int):
        text = np.concatenate([text, [0]]).astype(np.int32)  # the row of the last 0 comes before the first symbol
        self.n, m = len(text), np.int64(text.max())
        ahead = np.concatenate([text, np.zeros(depth, np.int32)])
        order = None
        for d in range((depth - 1) // 2 * 2, -1, -2):  # two symbols a pass, the last ones first
            key = ahead[d : d + self.n] * (m + 1)
            if d + 1 < depth:
                key += ahead[d + 1 : d + 1 + self.n]
            if order is None:
                order = np.argsort(key, kind="stable").astype(np.int32)
            else:
                key = key[order]
                order = order[np.argsort(key, kind="stable")]
            del key
        before = text[order - 1]
        del ahead, order
        #: Row by row, the row that begins one symbol on.
        self.on = np.argsort(before, kind="stable").astype(np.int32)
        self.rank = before[self.on].astype(np.int64)
        self.rank *= self.n
        self.rank += self.on

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of rows that begin with each phrase (one row of symbols), by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for j in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[:, j].astype(np.int64) * self.n
            low, high = np.searchsorted(self.rank, symbol + low), np.searchsorted(self.rank, symbol + high)
        return low, high

    def within(self, phrases: np.ndarray) -> np.ndarray:
        """Of each row, the phrase whose interval it is in, or -1."""
        low, high = self.search(phrases)
        size = high - low
        made = np.full(self.n, -1, np.int32)
        made[np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)] = np.repeat(np.arange(len(phrases)), size)
        return made

    def extend(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every extension by one symbol in front whose own beginning is one of the phrases, too: the
        phrase at its beginning, the one extended, and the count."""
        own = self.within(phrases)
        rest = own[self.on]
        there = (own >= 0) & (rest >= 0)
        own, rest = own[there], rest[there]
        if not len(own):
            return (np.zeros(0, np.int64),) * 3
        starts = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (rest[1:] != rest[:-1])))
        return own[starts], rest[starts], np.diff(np.append(starts, len(own)))


def longer(text: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases one word longer than the known ones (rows of symbols), both of whose parts are known:
    the first part, the last part (as numbers of known ones), and the count in this text."""
    k = known.shape[1] + 1
    of_known = np.zeros(int(max(text.max(initial=0), known.max(initial=0))) + 1, np.int32)
    of_known[known] = known
    text = without_runs(of_known[text])
    if k % 2 == 0:
        return Index(text, k).extend(known)
    last, first, counts = Index(text[::-1], k).extend(known[:, ::-1])
    return first, last, counts


KNOWN = ["p", "s", "id", "f"]
#: A block of what is known of a shard: m phrases of one length, in the order of their ids.
BLOCK = "shard long, level long, m long, p binary, s binary, id binary, f binary"


def block(p: np.ndarray, s: np.ndarray, id_: np.ndarray, f: np.ndarray) -> list[bytes]:
    return [packed(np.diff(p, prepend=0)), packed(s), packed(np.diff(id_, prepend=0)), packed(f)]


def unblock(m: int, p: bytes, s: bytes, id_: bytes, f: bytes) -> list[np.ndarray]:
    p, s, id_, f = (unpacked(raw, m, np.int64) for raw in (p, s, id_, f))
    return [np.cumsum(p), s, np.cumsum(id_), f]


def each_shard(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict[str, np.ndarray]]]:
    """Per shard, its text row and the columns of what is known of it, from rows in that order."""
    now, parts = None, []

    def whole() -> dict[str, np.ndarray]:
        return {c: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i, c in enumerate(["level", *KNOWN])}

    for batch in source:
        for row in batch.to_pylist():
            if row["text"] is not None:
                if now is not None:
                    yield now, whole()
                now, parts = row, []
            else:
                parts.append([np.full(row["m"], row["level"]), *unblock(row["m"], *(row[c] for c in KNOWN))])
    if now is not None:
        yield now, whole()


def in_symbols(text: np.ndarray, known: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text in symbols, in the order of the words' ids, and the phrases of k words that are
    known, as symbols and by their ids. Of words, p is the number in the shard; of phrases p and s
    are the ids of their parts."""
    ids = symbols = None
    for level in range(1, k + 1):
        here = np.flatnonzero(known["level"] == level)
        here = here[np.argsort(known["id"][here])]
        p, s = known["p"][here], known["s"][here]
        if level == 1:
            names = np.zeros(int(max(text.max(initial=0), p.max(initial=0))) + 1, np.int32)
            names[p] = np.arange(1, len(here) + 1)
            symbols = np.arange(1, len(here) + 1, dtype=np.int32)[:, None]
        else:
            first, last = np.searchsorted(ids, p), np.searchsorted(ids, s)
            symbols = np.column_stack([symbols[first], symbols[last, -1]])
        ids = known["id"][here]
    return names[text], symbols, ids


def with_known(texts: DataFrame, known: list[DataFrame], tasks: int) -> DataFrame:
    """The rows of both, each shard's text before what is known of it."""
    left = texts.select("shard", F.lit(0).cast("long").alias("level"), "text", "n", F.lit(None).cast("long").alias("m"), *(F.lit(None).cast("binary").alias(c) for c in KNOWN))
    for rows in known:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("text", "binary"), ("n", "long"))]
        left = left.unionByName(rows.select("shard", "level", *nothing, "m", *KNOWN))
    return left.repartition(tasks, "shard").sortWithinPartitions("shard", "level")


def known_words(found: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Blocks of each shard's words that are frequent; p is the word's number in the shard."""
    words = found.select("shard", "lang", F.posexplode("words").alias("at", "word")).join(bounded(vocabulary), ["lang", "word"])
    listed = words.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("id", (F.col("at") + 1).cast("long").alias("p"), "f"))).alias("w"))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 1):
            if batch.num_rows:
                id_, p, f = (batch.column(i).flatten().to_numpy() for i in (1, 2, 3))
                row = [batch.column(0), pa.array([1]), pa.array([len(p)]), *(pa.array([raw], pa.binary()) for raw in block(p, np.zeros_like(p), id_, f))]
                yield pa.RecordBatch.from_arrays(row, names=["shard", "level", "m", *KNOWN])

    return listed.select("shard", "w.id", "w.p", "w.f").mapInArrow(run, BLOCK)


def grown(texts: DataFrame, known: list[DataFrame], k: int, tasks: int, buckets: int) -> DataFrame:
    """(bucket, shard, m, p, s, counts): in compressed blocks, the phrases of k words of each shard,
    both of whose parts are known, by the ids of these, and how often they occur there."""
    names = ["bucket", "shard", "m", "p", "s", "counts"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, of in each_shard(source):
            text, symbols, ids = in_symbols(unpacked(row["text"], row["n"], np.int32), of, k - 1)
            first, last, counts = longer(text, symbols)
            p, s = ids[first], ids[last]
            mixed = (p.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (s.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            bucket = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % buckets
            order = np.lexsort((s, p, bucket))
            p, s, counts, bucket = p[order], s[order], counts[order], bucket[order]
            bounds = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else np.zeros(1, np.int64)
            for some in range(0, len(bounds) - 1, 512):
                rows = [(int(bucket[a]), row["shard"], int(b - a), packed(np.diff(p[a:b], prepend=0)), packed(s[a:b]), packed(counts[a:b])) for a, b in zip(bounds[some:-1][:512], bounds[some + 1 :][:512])]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (*(pa.int64(),) * 3, *(pa.binary(),) * 3))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return with_known(texts, known, tasks).mapInArrow(run, "bucket long, shard long, m long, p binary, s binary, counts binary")


def added_up(blocks: DataFrame, buckets: int, k: int, least: int, last: bool) -> DataFrame:
    """Two kinds of rows. Of each phrase of k words that is frequent in sum: sp, ss (the ids of its
    parts), sid and sf (its own id, its count). Unless ``last``, for each shard that has some of
    them a block of these, too."""
    names = ["shard", "level", "m", *KNOWN, "sp", "ss", "sid", "sf"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, now, held = TaskContext.get().partitionId() << 33, None, []

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal made
            m = np.array([h[1] for h in held])
            shard = np.repeat(np.array([h[0] for h in held]), m)
            p = np.concatenate([np.cumsum(unpacked(h[2], h[1], np.int64)) for h in held])
            s = np.concatenate([unpacked(h[3], h[1], np.int64) for h in held])
            counts = np.concatenate([unpacked(h[4], h[1], np.int64) for h in held])
            order = np.lexsort((s, p))
            shard, p, s, counts = shard[order], p[order], s[order], counts[order]
            new = np.append(True, (p[1:] != p[:-1]) | (s[1:] != s[:-1]))
            at = np.cumsum(new) - 1
            total = np.add.reduceat(counts, np.flatnonzero(new))
            ids = np.cumsum(total >= least) - 1 + made
            made += int((total >= least).sum())
            keep = np.flatnonzero(total[at] >= least)
            shard, p, s, new, ids, total = shard[keep], p[keep], s[keep], new[keep], ids[at[keep]], total[at[keep]]
            one = np.flatnonzero(new)
            nulls = [pa.nulls(len(one), t) for t in (*(pa.int64(),) * 3, *(pa.binary(),) * 4)]
            batch = pa.RecordBatch.from_arrays([*nulls, *(pa.array(c[one]) for c in (p, s, ids, total))], names=names)
            for start in range(0, batch.num_rows, 100_000):
                yield batch.slice(start, 100_000)
            if last or not len(shard):
                return
            order = np.argsort(shard, kind="stable")
            shard, p, s, ids, total = shard[order], p[order], s[order], ids[order], total[order]
            bounds = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
            for some in range(0, len(bounds) - 1, 512):
                rows = [(int(shard[a]), k, int(b - a), *block(p[a:b], s[a:b], ids[a:b], total[a:b])) for a, b in zip(bounds[some:-1][:512], bounds[some + 1 :][:512])]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (*(pa.int64(),) * 3, *(pa.binary(),) * 4))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(rows), pa.int64()),) * 4], names=names)

        for batch in source:
            for bucket, *part in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if bucket != now and held:
                    yield from out()
                    held = []
                now = bucket
                held.append(part)
        if held:
            yield from out()

    rows = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, f"{BLOCK}, sp long, ss long, sid long, sf long")


def cuts(k: int) -> list[str]:
    """Columns for the counts of a phrase's parts: lj of its first j words, rj of the rest."""
    return [f"{side}{j}" for side in "lr" for j in range(1, k)]


def with_parts(rows: DataFrame, shorter: DataFrame, k: int) -> DataFrame:
    """(lang, id, p, s, last, f, l1.., r1..) of phrases (p, s, id, f), from those of one word less."""
    first = shorter.select(F.col("id").alias("p"), "lang", F.col("f").alias(f"l{k - 1}"), *(f"l{j}" for j in range(1, k - 1)))
    rest = shorter.select(F.col("id").alias("s"), "last", F.col("f").alias("r1"), *(F.col(f"r{j - 1}").alias(f"r{j}") for j in range(2, k)))
    return rows.join(bounded(land(first, "parts")), "p").join(bounded(land(rest, "parts")), "s").select("lang", "id", "p", "s", "last", "f", *cuts(k))


def frequent(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent words (lang, word, id, f) and, for each length from 2, phrases (lang, id,
    p, s, last, f, l1.., r1..), and the number of words of each language (lang, total)."""
    found = land(shards(docs, text_col, lang_col), "shards")
    counts = found.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    vocabulary = land(counts.where(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id()), "vocabulary")
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    totals = found.groupBy("lang").agg(F.sum(size).alias("total"))
    numbers = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks, buckets = tasks_for(numbers, TASK_TOKENS, 8), tasks_for(numbers, BUCKET_TOKENS, 8)
    known = [land(known_words(found, vocabulary), "known")]
    levels = [vocabulary.withColumn("last", F.col("id"))]
    for k in range(2, longest + 1):
        blocks = land(grown(found, known, k, tasks, buckets), "phrases")
        made = land(added_up(blocks, buckets, k, least, k == longest), "known")
        known.append(made.where("shard IS NOT NULL"))
        phrases = made.where("shard IS NULL").select(*(F.col(f"s{c}").alias(c) for c in KNOWN))
        levels.append(land(with_parts(phrases, levels[-1], k), "frequent"))
    return levels, totals


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), numbers long: each language's first phrases."""
    levels, totals = frequent(docs, text_col=text_col, lang_col=lang_col, longest=longest, least=least)
    scored = None
    for k in range(2, longest + 1):
        rows = levels[k - 1]
        if k < longest:  # what holds it and is longer by one word
            more = levels[k]
            held = more.select(F.explode(F.array("p", "s")).alias("id"), F.col("f").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
            rows = rows.join(bounded(land(held, "longer")), "id", "left").where(F.coalesce(100 * F.col("longer") < COVERED * F.col("f"), F.lit(True)))
        product = f"CAST({HIGHEST} AS DECIMAL(18,0)) * CAST(f AS DECIMAL(20,0))"  # may pass 64 bits
        score = [F.expr(f"{product} div CAST(l{j} + r{j} AS DECIMAL(20,0))") for j in range(1, k)]
        best = F.array_min(F.array(*(F.struct(score[j - 1].alias("score"), F.lit(j).alias("k"), F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r")) for j in range(1, k)))).alias("cut")
        rows = rows.select("lang", F.lit(k).alias("words"), "p", "last", F.col("f").alias("a"), best)
        scored = rows if scored is None else scored.unionByName(rows)
    # ties at the last place stay until their texts are known
    by_score = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"))
    near = land(scored.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= first).drop("place").withColumn("row", F.monotonically_increasing_id()), "near")
    texts = None
    for k in range(2, longest + 1):
        chain = near.where(F.col("words") == k).select("row", "p", F.array("last").alias("ids"))
        for shorter in range(k - 1, 1, -1):
            up = levels[shorter - 1].select(F.col("id").alias("p"), F.col("p").alias("p2"), F.col("last").alias("last2"))
            chain = chain.join(up, "p").select("row", F.col("p2").alias("p"), F.concat(F.array("last2"), "ids").alias("ids"))
        chain = chain.select("row", F.posexplode(F.concat(F.array("p"), "ids")).alias("at", "id"))
        texts = chain if texts is None else texts.unionByName(chain)
    spelled = texts.join(levels[0].select("id", "word"), "id").groupBy("row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x.word), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = near.join(spelled, "row").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= first).join(F.broadcast(land(totals, "totals")), "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece
  FROM documents
), listed AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]'), lambda w: w <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: list_slice(ws, i, i + k - 1))) AS g
  FROM listed, (VALUES (1), (2), (3), (4)) AS ks(k) WHERE len(ws) >= k
), f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k >= 2 AND f >= 30),
inside AS (
  SELECT lang, list_slice(g, i, i + k2 - 1) AS g, max(f) AS longer
  FROM c, (VALUES (2), (3)) AS sizes(k2), (VALUES (1), (2), (3)) AS starts(i)
  WHERE k2 < k AND i + k2 - 1 <= k GROUP BY ALL
), cut AS (
  SELECT c.lang, c.g, c.f AS a, j, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM c CROSS JOIN (VALUES (1), (2), (3)) AS js(j)
  JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, j) JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, j + 1, c.k)
  LEFT JOIN inside i ON i.lang = c.lang AND i.g = c.g
  WHERE j < c.k AND (i.longer IS NULL OR 100 * i.longer < 80 * c.f)
), best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, score FROM best
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op11_phrases", SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
