"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line breaks, pieces into words. A run of texts becomes
arrays of word hashes; prefix polynomials over them give the fingerprint of every n-gram as a difference of two prefix
values, for all places at once.

The table is counted twice. First every n-gram of 1 to 4 words is counted in the bucket that its fingerprint names: a task
sorts the buckets of some million places and sends each bucket met in three bytes with its count, packed in one row per
order and range of buckets; counts are cut at the least count that matters, so a bucket's sum reaches it exactly if the
bucket's n-grams do together. Then the n-grams whose bucket reached it, and whose parts' buckets did, are counted by their
words. Buckets only prune: no n-gram of enough occurrences is lost, and words that share a bucket or a fingerprint are
counted apart. So the first pass shuffles a few bytes per distinct n-gram of a task whatever is frequent, and the second
one little besides the frequent phrases. The buckets that reached the count are broadcast as a bitmap, whose size follows
their number up to 2^27 bits (16 MB), the one thing broadcast whole; it forgets nothing, a full one only prunes less.

Fingerprints hold a hash of the language. The empty phrase occurs at every word, so its count is the number of words of a
language.

docs is read three times (once for the size of its texts); store it first if it is costly to compute.

Defined cases: null or empty text has no words; a null language is ``und``; repeated rows count each; a very long text is
processed as a run of its own; ties are broken by the phrase's bytes; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from sparkwright.llm.textutil import mixed, slices, texts_of
from sparkwright.session import stored

LONGEST = 4
MIN_COUNT, TOP = 30, 2000
RUN_BYTES = 3 << 20
BUCKET_BITS = 24                           # of a bucket inside its range
HELD = 4 << 20                             # places of n-grams that a task sorts at once
MOST_BITS = 1 << 27
BROADCAST_ROWS = 200_000
SALTS, HOT_CUTS, MOST_HOT = 32, 10_000, 10_000
_BREAK, _END = b"\xff", b"\xfe"            # between pieces and texts: bytes that UTF-8 text does not hold
_MARKS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", _BREAK * 10)
_BASES = np.array([0x9E3779B97F4A7C15, 0xD1342543DE82EF95], np.uint64)


def words_and_breaks(texts: list[bytes]) -> list[bytes]:
    """Words in order, marks between pieces and behind texts."""
    whole = (b" " + _END + b" ").join([*texts, b""])
    return whole.lower().translate(_MARKS).replace(_BREAK, b" \xff ").split()


class _WordHashes(dict):
    """Number of each word met, with two hashes per number; numbers 0 and 1 are the marks."""

    def __init__(self, bound: int = 200_000):
        super().__init__()
        self.bound = bound
        self.restart()

    def restart(self):
        self.clear()
        self.update({_BREAK: 0, _END: 1})
        self.raw = bytearray(32)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.raw += xxh3_128_digest(word)
        return number

    def hashes(self) -> np.ndarray:
        return np.frombuffer(bytes(self.raw), np.uint64).reshape(-1, 2)


class _Powers:
    """Powers of the two bases and of their inverses modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones((1, 2), np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            n = 1 << n.bit_length()
            inverse = np.array([pow(int(b), -1, 1 << 64) for b in _BASES], np.uint64)
            self.up, self.down = (np.concatenate([np.ones((1, 2), np.uint64), np.multiply.accumulate(np.tile(b, (n, 1)), axis=0)])
                                  for b in (_BASES, inverse))
        return self.up, self.down


class Run:
    """The words of some texts as arrays, with the fingerprints of their n-grams."""

    def __init__(self, texts: list[bytes], langs: list[str], hashes: _WordHashes, powers: _Powers):
        if len(hashes) > hashes.bound:
            hashes.restart()
        flat = words_and_breaks(texts)
        numbers = np.fromiter(map(hashes.__getitem__, flat), np.int32, len(flat))
        place = np.flatnonzero(numbers > 1)
        self.numbers = numbers[place]
        self.text = np.cumsum(numbers == 1, dtype=np.int32)[place]
        self.piece = np.cumsum(numbers <= 1, dtype=np.int32)[place]
        self.lang = np.array([xxh3_64_intdigest((x or "und").encode("utf-8", "replace")) for x in langs], np.uint64)[self.text]
        self.hashes, self.powers = hashes, powers

    def starts(self, m: int) -> np.ndarray:
        """For every place whether m words inside one piece begin there."""
        out = np.zeros(len(self.piece), bool)
        if 0 < m <= len(out):
            out[:len(out) - m + 1] = self.piece[m - 1:] == self.piece[:len(out) - m + 1]
        return out

    def prefix(self, lane: int) -> np.ndarray:
        """Prefix polynomial of the word hashes, by the first or the second hash and base."""
        out = np.zeros(len(self.numbers) + 1, np.uint64)
        np.cumsum(self.hashes.hashes()[self.numbers, lane] * self.powers.upto(len(self.numbers))[0][:len(self.numbers), lane], out=out[1:])
        return out

    def fingerprints(self, m: int, prefix: np.ndarray, lane: int) -> np.ndarray:
        """Fingerprints of the m words from each place on (the last m - 1 places have none)."""
        n = max(0, len(self.numbers) - m + 1)
        poly = (prefix[m:][:n] - prefix[:n]) * self.powers.upto(n)[1][:n, lane]
        return mixed(poly + (self.lang[:n] + np.uint64(m)))

    def phrases(self, starts: np.ndarray, m: int) -> pa.Array:
        """The m words from some places on, joined by spaces."""
        words = pa.array(list(self.hashes), pa.binary())
        return pc.binary_join_element_wise(*(words.take(pa.array(self.numbers[starts + i])) for i in range(m)), pa.scalar(b" ", pa.binary()))


class Buckets:
    """Numbers of the buckets of n-grams: the order, the range (2^ranges for each order) and the bucket in it."""

    def __init__(self, ranges: int, bits: int = 64):
        self.shift = np.uint64(ranges + BUCKET_BITS)
        self.mask = np.uint64((1 << min(bits, ranges + BUCKET_BITS)) - 1)

    def __call__(self, m: int, fp: np.ndarray) -> np.ndarray:
        return (np.uint64(m - 1) << self.shift) | (fp & self.mask)


class Bitmap:
    """Fixed-size set of fingerprints that forgets none: two bits of 2^k for each."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def __call__(self, fp: np.ndarray) -> np.ndarray:
        size, out = np.uint64(len(self.cells) * 64 - 1), np.ones(len(fp), bool)
        for at in (fp & size, (fp >> np.uint64(32)) & size):
            out &= (self.cells[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out

    @classmethod
    def of(cls, rows: DataFrame, column: str) -> "Bitmap":
        """Built by Spark; at most 2^21 cells come to the driver."""
        size = min(MOST_BITS, max(1 << 16, 1 << (16 * rows.count()).bit_length()))
        fp = F.col(column)
        at = rows.select(F.explode(F.array(fp.bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned(fp, 32).bitwiseAND(F.lit(size - 1)))).alias("at"))
        cells = at.groupBy(F.shiftright("at", 6).alias("cell")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits")).toArrow()
        out = np.zeros(size >> 6, np.uint64)
        out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
        return cls(out)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """lang, text."""
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def _runs(batches):
    hashes, powers = _WordHashes(), _Powers()
    for whole in batches:
        for batch in slices(whole, RUN_BYTES):
            yield batch, Run(texts_of(batch), batch.column("lang").to_pylist(), hashes, powers)


def _packed(held: list[np.ndarray], least: int) -> pa.RecordBatch:
    """range, buckets (three bytes each, ascending), counts (cut at ``least``) of some bucket numbers."""
    numbers = np.concatenate(held)
    numbers.sort()
    cut = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
    counts = np.minimum(np.diff(np.r_[cut, len(numbers)]), least).astype(np.min_scalar_type(least))
    numbers = numbers[cut]
    at = (numbers >> np.uint64(BUCKET_BITS)).astype(np.int32)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    ends = np.r_[first, len(at)]
    buckets = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3])

    def cells(values, width):
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(values)])

    return pa.RecordBatch.from_arrays([pa.array(at[first]), cells(buckets, 3), cells(counts, counts.itemsize)], names=["range", "buckets", "counts"])


def bucket_counts(texts: DataFrame, least: int, number: Buckets) -> DataFrame:
    """range, buckets, counts: the buckets of all n-grams as the tasks met them."""
    def run(batches):
        held, size = [], 0
        for _, texts_run in _runs(batches):
            prefix = texts_run.prefix(0)
            for m in range(1, LONGEST + 1):
                fp = texts_run.fingerprints(m, prefix, 0)
                held.append(number(m, fp[texts_run.starts(m)[:len(fp)]]))
                size += len(held[-1])
                if size >= HELD:
                    yield _packed(held, least)
                    held, size = [], 0
        if size:
            yield _packed(held, least)

    return texts.mapInArrow(run, "range int, buckets binary, counts binary")


def frequent_buckets(texts: DataFrame, min_count: int, number: Buckets, tasks: int) -> DataFrame:
    """fp: the mixed numbers of the buckets whose n-grams have together at least min_count occurrences."""
    least = min(max(1, min_count), 1 << 31)

    def frequent(rows: pa.Table) -> pa.Table:
        cells = np.frombuffer(b"".join(rows.column("buckets").to_pylist()), np.uint8).reshape(-1, 3).astype(np.uint64)
        both = cells[:, 0] | cells[:, 1] << np.uint64(8) | cells[:, 2] << np.uint64(16)
        both = both << np.uint64(32) | np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.min_scalar_type(least))
        both.sort()
        bucket = both >> np.uint64(32)
        cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        kept = bucket[cut][np.add.reduceat(both & np.uint64(0xFFFFFFFF), cut) >= least]
        at = np.uint64(rows.column("range")[0].as_py()) << np.uint64(BUCKET_BITS)
        return pa.table({"fp": mixed(at | kept).view(np.int64)})

    return bucket_counts(texts, least, number).repartition(tasks, "range").groupBy("range").applyInArrow(frequent, "fp long")


def counted_by_words(texts: DataFrame, number: Buckets, frequent: Bitmap) -> DataFrame:
    """lang, phrase, f: parts of the counts of the n-grams whose buckets, and whose parts' buckets, are frequent."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for batch, texts_run in _runs(batches):
            langs, words = batch.column("lang"), np.bincount(texts_run.text, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([langs, pa.array([b""] * len(langs), pa.binary()), pa.array(words)], names=["lang", "phrase", "f"])
            lanes = [texts_run.prefix(0), texts_run.prefix(1)]
            for m in range(1, LONGEST + 1):
                fp = texts_run.fingerprints(m, lanes[0], 0)
                hit = texts_run.starts(m)
                if m > 1:
                    hit[:-1] &= shorter[:-1] & shorter[1:]
                at = np.flatnonzero(hit)
                at = at[sent.value(mixed(number(m, fp[at])))]
                shorter = np.zeros_like(hit)
                shorter[at] = True
                if not len(at):
                    break
                fp, second = fp[at], texts_run.fingerprints(m, lanes[1], 1)[at]
                by = np.argsort(fp)
                fp, second, at = fp[by], second[by], at[by]
                cut = np.flatnonzero(np.r_[True, (fp[1:] != fp[:-1]) | (second[1:] != second[:-1])])
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(texts_run.text[at[cut]])), texts_run.phrases(at[cut], m),
                                                  pa.array(np.diff(np.r_[cut, len(at)]))], names=["lang", "phrase", "f"])

    return texts.mapInArrow(run, "lang string, phrase binary, f long")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang", bits: int = 64) -> DataFrame:
    """m, lang, phrase, f: all phrases of 0 to 4 words with at least min_count occurrences; stored.

    ``bits`` cuts the fingerprints (to make them share buckets in tests); the result does not depend on it."""
    texts = _texts(docs, text_col, lang_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # 2^10 ranges up to 64 GB of text, more beyond: the buckets of an order and range are one group, of about a quarter of 64 MB
    number = Buckets(min(max(2, (size >> 20).bit_length()), max(10, (size >> 26).bit_length())), bits)
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), size >> 26)
    frequent = Bitmap.of(stored(frequent_buckets(texts, min_count, number, tasks), "phrases_buckets"), "fp")
    counts = counted_by_words(texts, number, frequent).groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    phrase = F.col("phrase").cast("string")
    return stored(counts.select(F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ", -1))).alias("m"), "lang", phrase.alias("phrase"), "f"), "phrases")


def _salted(table: DataFrame, name: str, hot: int) -> DataFrame:
    """table with a column _t: rows whose count reaches ``hot`` once for every salt, the others once with 0."""
    return table.withColumn("_t", F.explode(F.when(F.col(name) >= hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))


def _with_counts(cuts: DataFrame, counts: DataFrame, part: str, name: str, hot: int | None) -> DataFrame:
    """cuts with the count of their column ``part``; beyond the broadcast bound (``hot`` given) hot parts are spread by salts."""
    table = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name))
    on = (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))
    if hot is None:
        return cuts.join(F.broadcast(table), on).drop("_lang", "_part")
    spread = F.when(F.col("_part").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    marked = cuts.join(F.broadcast(table.where(F.col(name) >= hot).drop(name)), on, "left").withColumn("_s", spread).drop("_lang", "_part")
    return marked.join(_salted(table, name, hot), on & (F.col("_s") == F.col("_t"))).drop("_lang", "_part", "_s", "_t")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
                 bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to 4 words.

    A phrase is cut after its first k words, l and r count the parts, and the cut of least floor(2000000 a / (l + r)) counts
    (ties: the smallest k). Phrases are left out if one longer frequent phrase around them has at least 80 % of
    their occurrences; one of just one more word then does, too, so only those are looked at."""
    counts = frequent_phrases(docs, min_count, text_col, lang_col, bits)
    words = F.split("phrase", " ", -1)
    part = lambda a, n: F.concat_ws(" ", F.slice("words", a, n))
    phrases = counts.where(F.col("m") >= 2).withColumn("words", words)
    hot = None
    if counts.count() > BROADCAST_ROWS:
        # a part begins (ends) at most 3 f / min_count frequent phrases; parts of so many occurrences are at most 3 MOST_HOT
        hot = max(min_count * HOT_CUTS, counts.where(F.col("m") == 0).agg(F.sum("f")).first()[0] // MOST_HOT)
    cuts = phrases.select("lang", "phrase", "m", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")) \
        .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("_first"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("_rest"))
    parts = counts.where(F.col("m").between(1, LONGEST - 1))
    both = _with_counts(_with_counts(cuts, parts, "_first", "l", hot), parts, "_rest", "r", hot)
    exact = F.expr("CAST(a AS decimal(20,0)) * 2000000BD div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    scored = both.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")) \
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")

    around = phrases.where(F.col("m") >= 3).select(
        F.col("lang").alias("_lang"), "f", F.explode(F.array(part(F.lit(1), F.col("m") - 1), part(F.lit(2), F.col("m") - 1))).alias("_inner")) \
        .groupBy("_lang", "_inner").agg(F.max("f").alias("_around"))
    inside = (F.col("_around").cast("decimal(20,0)") * 100) >= (F.col("a").cast("decimal(20,0)") * 80)
    kept = scored.join(around, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_inner")), "left") \
        .where(F.col("_around").isNull() | ~inside)

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = kept.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))) \
        .withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))).where(F.col("_r") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    n = counts.where(F.col("m") == 0).select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = rf"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3), (4)) o(m) WHERE len(ws) >= m),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS ws FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30),
part AS MATERIALIZED (SELECT lang, phrase, f AS a, k, array_to_string(ws[1:k], ' ') AS p1, array_to_string(ws[k + 1:], ' ') AS p2
                      FROM f, (VALUES (1), (2), (3)) o(k) WHERE m > k),
cut AS (SELECT part.lang, part.phrase, a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score
        FROM part JOIN f l ON l.lang = part.lang AND l.phrase = p1 JOIN f r ON r.lang = part.lang AND r.phrase = p2),
best AS MATERIALIZED (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_of AS (SELECT f.lang, f.f, array_to_string(ws[i:j], ' ') AS phrase FROM f, (VALUES (1), (2), (3)) a(i), (VALUES (2), (3), (4)) b(j)
             WHERE m >= 3 AND j <= m AND i < j AND j - i + 1 < m),
around AS (SELECT lang, phrase, max(f) AS most FROM inner_of GROUP BY lang, phrase),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN n USING (lang) LEFT JOIN around USING (lang, phrase)
WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a QUALIFY rank <= 2000"""
