r"""Line dedup by a deletion-neighbourhood join.

Lines are split at \n.  A line counts by its words (A-Z in lower case; runs of letters a-z, digits and anything beyond
ASCII); a line without words is left alone.  A line is removed when an equal one, or one within the edit bound, stands
earlier, that is at a smaller (doc_id, line number); of different texts with one doc_id that of smaller md5 is the earlier one.  The bound is one word inserted, deleted or replaced, for lines of at
least `NEAR_WORDS` words; shorter lines must be equal.  Lines are judged on the input, not on what is left, so the result
depends on no order of work.

1. Each line becomes a 128-bit hash of its words; equal lines form a class with its earliest place.
2. Two lines within one edit have their first or their last half in common, where a half is a run of words whose length
   comes from the line's length.  Classes that share no half with another class have no neighbour and stop here.
3. The others are numbered by place and emit the deletion neighbourhood as hashed keys: the whole line, and for every word the
   line without it.  Keys of one line only go.  Equal keys are joined by minima, not by pairs: lines of one length that agree
   after losing the word at one position are within one replacement of each other, and a line equal to another one that lost a
   word is within one insertion.
4. For every line that got an earlier neighbour this way the edit distance is verified on the words themselves; only then
   does the neighbour count.

Defined results: null and empty texts have no line with words and stay as they are.  Rows that repeat doc_id and text share
their places, and a place is never earlier than itself, so repeated rows keep or lose the same lines.  Extra columns pass through.
A document whose lines with words all went is dropped by `clean`; documents that had none stay.

Scale: what is shuffled is a few longs a line, the neighbourhoods of step 3, and the texts that hold such lines.  All
grouping takes minima and counts, which combine on the map side, so a line that stands in a third of all documents is
spread out; joins with its occurrences are split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_episodes.functions.scan import null_safe_join, ordered_parts, running_sums
from care_episodes.llm.buffers import slices, utf8
from care_episodes.llm.columns import packed, unpacked
from care_episodes.llm.mixing import ranked
from care_episodes.llm.words import LETTERS, LOWER, mixed, powers, word_hashes
from care_episodes.session import materialize

NEAR_WORDS = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


def half(words: np.ndarray) -> np.ndarray:
    """Length of the half of a line: at most half its words, in steps of a fifth, so that lengths share halves."""
    ladder = [1]
    while ladder[-1] < (1 << 40):
        ladder.append(max(ladder[-1] + 1, ladder[-1] * 6 // 5))
    steps = np.array(ladder, np.int64)
    return steps[np.maximum(np.searchsorted(steps, words // 2, side="right") - 1, 0)]


class Lines:
    """The lines with words of a slice of texts."""

    def __init__(self, column: pa.Array):
        data, offsets = utf8(column)
        breaks = np.flatnonzero(data == 10)
        # A line break belongs to the row it stands in; every row starts a line too.
        row_of_break = np.searchsorted(offsets, breaks, side="right") - 1
        starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
        self.texts = len(offsets) - 1
        row = np.sort(np.concatenate([np.arange(self.texts), row_of_break]), kind="stable")
        first = np.searchsorted(row, np.arange(self.texts))
        self.n_lines = np.diff(np.append(first, len(row)))
        hashes, at, _, _ = word_hashes(LOWER[data], np.unique(np.append(starts, len(data))), LETTERS)
        # Equal starts (an empty row, then the next one) must send a word to the last of them.
        line = np.searchsorted(starts, at, side="right") - 1
        self.hashes = hashes
        begin = np.searchsorted(line, np.arange(len(starts)))
        end = np.append(begin[1:], len(line))
        has = end > begin
        self.row, self.no = row[has], (np.arange(len(row)) - first[row])[has]
        self.begin, self.end = begin[has], end[has]
        self.words = self.end - self.begin
        self._pow = powers(len(hashes) + 1)
        inverse = pow(0xD6E8FEB86659FD93, -1, 1 << 64)
        self._inv = powers(len(hashes) + 1, inverse)
        second = mixed(hashes + _STEP)
        self._one = np.concatenate([[np.uint64(0)], np.cumsum(hashes * self._pow[:-1], dtype=np.uint64)])
        self._two = np.concatenate([[np.uint64(0)], np.cumsum(second * self._pow[:-1], dtype=np.uint64)])

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words a..b-1."""
        return mixed((self._one[b] - self._one[a]) * self._inv[a] + (b - a).astype(np.uint64) * _STEP)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that name each line."""
        a, b = self.begin, self.end
        other = mixed((self._two[b] - self._two[a]) * self._inv[a] + (b - a).astype(np.uint64))
        return self.run(a, b).view(np.int64), other.view(np.int64)

    def halves(self) -> list[np.ndarray]:
        """Keys of the first and last half, for partners of the same length, and for those one word shorter."""
        keys = []
        for less in (0, 1):
            h = half(np.maximum(self.words - less, 2))
            for side, key in ((1, self.run(self.begin, self.begin + h)), (2, self.run(self.end - h, self.end))):
                keys.append(mixed(key + h.astype(np.uint64) * np.uint64(4) + np.uint64(side)).view(np.int64))
        return keys

    def neighbourhood(self, k: int) -> np.ndarray:
        """For line k: keys of the line without the word at each position."""
        a, b = int(self.begin[k]), int(self.end[k])
        at = np.arange(a, b)
        low, high = self._one[at] - self._one[a], self._one[b] - self._one[at + 1]
        whole = low * self._inv[a] + high * self._inv[a + 1]
        return mixed(whole + np.uint64((b - a - 1) * int(_STEP) % (1 << 64))).view(np.int64)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        lines = Lines(batch.column(1))
        one, two = lines.names()
        keys = lines.halves()
        near = lines.words >= NEAR_WORDS
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(lines.row)), pa.array(lines.no.astype(np.int64)), pa.array(one), pa.array(two),
                *[pa.array(k, mask=~near) for k in keys],
            ],
            names=["doc_id", "line", "h1", "h2", "k1", "k2", "k3", "k4"],
        )


KEYS = ("k1", "k2", "k3", "k4")


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(no, key, at, length, words) of the wanted lines: the whole line at -1 with its words, and less the word at each position."""
    for batch in slices(batches, "text", most_rows=64):
        lines = Lines(batch.column(0))
        one, two = lines.names()
        wanted = {(w["h1"], w["h2"]): w["no"] for row in batch.column(1).to_pylist() for w in row}
        found = [(k, wanted.pop((int(one[k]), int(two[k])), None)) for k in np.flatnonzero(lines.words >= NEAR_WORDS)]
        found = [(k, no) for k, no in found if no is not None]
        for start in range(0, len(found), 500):
            part = found[start : start + 500]
            sizes = np.array([lines.words[k] for k, _ in part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([no for _, no in part], sizes + 1)),
                    pa.array(np.concatenate([np.append(one[k], lines.neighbourhood(k)) for k, _ in part])),
                    pa.array(np.concatenate([np.arange(-1, n) for n in sizes]).astype(np.int32)),
                    pa.array(np.repeat(sizes, sizes + 1).astype(np.int32)),
                    pa.array([w for (k, _), n in zip(part, sizes, strict=True) for w in [lines.hashes[lines.begin[k] : lines.end[k]].tobytes()] + [None] * n], pa.binary()),
                ],
                names=["no", "key", "at", "length", "words"],
            )


def edit_distance_within_one(a: bytes, b: bytes) -> bool:
    """Whether two word sequences (8 bytes a word) differ by one word inserted, deleted or replaced at most."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if abs(len(x) - len(y)) > 1:
        return False
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    front = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(x[::-1][:n] != y[::-1][:n])
    back = int(differ[0]) if len(differ) else n
    return max(len(x), len(y)) - min(front + back, n) <= 1


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        good = [edit_distance_within_one(x, y) for x, y in zip(a, b, strict=True)]
        yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))


def earlier_neighbours(variants: DataFrame) -> DataFrame:
    """(no, other): the earliest line within one edit that stands before line `no`."""
    shared = variants.groupBy("key").agg(F.min("no").alias("x"), F.max("no").alias("y")).where("x < y").select("key")
    keys = materialize(variants.join(shared, "key"))
    replaced = keys.where("at >= 0").groupBy("key", "length", "at").agg(F.min("no").alias("other"), F.max("no").alias("last")).where("other < last")
    moved = keys.groupBy("key").agg(
        F.min(F.when(F.col("at") < 0, F.col("no"))).alias("whole"), F.min(F.when(F.col("at") >= 0, F.col("no"))).alias("longer")
    ).where("whole is not null and longer is not null")
    return (
        keys.join(replaced.drop("last"), ["key", "length", "at"]).select("no", "other")
        .union(keys.join(moved, "key").select("no", F.when(F.col("at") < 0, F.col("longer")).otherwise(F.col("whole")).alias("other")))
        .where("other < no").groupBy("no").agg(F.min("other").alias("other"))
    )


def keyed(docs: DataFrame) -> DataFrame:
    """The packed rows with text and doc_id, where doc_id becomes (doc_id, version): different texts of one id are told apart by number."""
    ids = docs.where("text is not null").select("doc_id", F.md5("text").alias("hash")).distinct()
    several = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    parts = ordered_parts(null_safe_join(ids, several, ["doc_id"], "left_semi"), ["doc_id"], ["hash"])
    versions = materialize(running_sums(parts, ["doc_id"], ["hash"], {"version": F.lit(1)}).select("doc_id", "hash", "version"))
    rows = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"), hash=F.md5("text"))
    both = null_safe_join(rows, versions, ["doc_id", "hash"], "left")
    return both.select("row", "text", F.struct("doc_id", F.coalesce("version", F.lit(0)).cast("int").alias("version")).alias("doc_id"))


def place() -> Column:
    return F.struct("doc_id", "line")


def classes_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, line, h1, h2) of every line with words, and (h1, h2, n, first, near) of every class that loses lines.

    `first` is the earliest place of an equal line, `near` the earliest one of a line within the bound (or null).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    lines = materialize(
        docs.select("doc_id", "text").mapInArrow(
            _lines, f"doc_id {kind}, line long, h1 long, h2 long, k1 long, k2 long, k3 long, k4 long"
        )
    )
    classes = materialize(
        lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place()).alias("first"), *[F.any_value(k).alias(k) for k in KEYS])
    )
    halves = classes.where("k1 is not null").select("h1", "h2", F.explode(F.array_distinct(F.array(*KEYS))).alias("key"))
    shared = halves.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"), F.min("h2").alias("c"), F.max("h2").alias("d"))
    shared = shared.where("a != b or c != d").select("key")
    meeting = halves.join(shared, "key").select("h1", "h2").distinct()
    meeting = classes.join(meeting, ["h1", "h2"], "left_semi").select("h1", "h2", "first")
    meeting = materialize(ranked(meeting.withColumn("order", F.struct("first", "h1", "h2")), "order", "no").drop("order"))
    # The words of those classes come from the texts that hold their earliest lines.
    owners = meeting.groupBy(F.col("first.doc_id").alias("owner")).agg(F.collect_list(F.struct("h1", "h2", "no")).alias("wanted"))
    texts = docs.select("doc_id", "text").join(owners, F.col("doc_id").eqNullSafe(F.col("owner"))).select("text", "wanted")
    variants = materialize(texts.mapInArrow(_variants, "no long, key long, at int, length int, words binary"))
    words = variants.where("at < 0").dropDuplicates(["no"]).select("no", "words")
    near = (
        earlier_neighbours(variants.drop("words"))
        .join(words.withColumnRenamed("words", "own"), "no")
        .join(words.select(F.col("no").alias("other"), "words"), "other")
        .select("no", "other", "own", "words")
        .mapInArrow(_verified, "no long, other long")
        .join(meeting.select("no", "h1", "h2"), "no")
        .join(meeting.select(F.col("no").alias("other"), F.col("first").alias("near")), "other")
        .select("h1", "h2", "near")
    )
    return lines.drop(*KEYS), materialize(
        classes.select("h1", "h2", "n", "first").join(near, ["h1", "h2"], "left").where("n > 1 or near is not null")
    )


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, version, line, near, first_doc_id, first_line) of every line that goes; `near` where no equal line stands earlier."""
    found = _removed(keyed(docs))
    return found.select("doc_id.doc_id", "doc_id.version", "line", "near", F.col("first_doc_id.doc_id").alias("first_doc_id"), "first_line")


def _removed(docs: DataFrame) -> DataFrame:
    lines, classes = classes_of(docs)
    at = F.struct("doc_id", "line")
    return (
        lines.join(classes, ["h1", "h2"])
        .withColumn("equal_before", F.col("first") < at)
        .where(F.col("equal_before") | (F.col("near") < at))
        .withColumn("source", F.when(F.col("equal_before"), F.least("first", "near")).otherwise(F.col("near")))
        .select("doc_id", "line", (~F.col("equal_before")).alias("near"), F.col("source.doc_id").alias("first_doc_id"), F.col("source.line").alias("first_line"))
        .distinct()
    )


def _without(text: Column, gone: Column) -> Column:
    """The text less the lines numbered in `gone`, and how many of its lines are left."""
    return F.array_join(
        F.filter(
            F.transform(F.split(text, "\n", -1), lambda line, i: F.when(~F.array_contains(gone, i.cast("long")), line)),
            lambda line: line.isNotNull(),
        ),
        "\n",
    )


def _decided(docs: DataFrame) -> DataFrame:
    """The packed rows with `gone` (line numbers) and `n_near`."""
    rows = keyed(docs)
    gone = _removed(rows).groupBy(F.col("doc_id").alias("gone_id")).agg(
        F.sort_array(F.collect_list("line")).alias("gone"), F.count_if("near").alias("n_near")
    )
    rows = rows.withColumnRenamed("doc_id", "id")
    return rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")), "left")


def clean(docs: DataFrame) -> DataFrame:
    """The documents with their texts less the removed lines; a document that loses all its lines with words goes."""
    rows = _decided(docs).withColumn("left", F.when(F.col("gone").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("gone"))))
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    rows = rows.where(F.col("gone").isNull() | F.col("left").rlike(word))
    return unpacked(rows.drop("text").withColumnRenamed("left", "text"), "text").select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, n_near and the md5 of the text that is left (null text: null) for every row."""
    n = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("gone")))
    return _decided(docs).select(
        F.col("id.doc_id").alias("doc_id"),
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_removed"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.md5(text.cast("binary")).alias("left_md5"),
    )


#: Deletion neighbourhoods of all lines, without the halves that save work.
ORACLE = r"""
WITH raw AS (SELECT doc_id, dense_rank() OVER (PARTITION BY doc_id ORDER BY md5(text)) AS v, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, v, (i - 1)::BIGINT AS line, regexp_extract_all(
           translate(parts[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM raw, unnest(range(1, len(parts) + 1)) AS t(i)),
distinct_lines AS (SELECT words, min({'doc_id': doc_id, 'v': v, 'line': line}) AS first FROM lines WHERE len(words) > 0 GROUP BY words),
long_lines AS (SELECT words, len(words) AS n, first FROM distinct_lines WHERE len(words) >= 8),
shorter AS (
  SELECT words, n, first, i, md5(array_to_string(words[1 : i - 1] || words[i + 1 :], ' ')) AS key
  FROM long_lines, unnest(range(1, n + 1)) AS t(i)),
replaced AS (SELECT n, i, key, min(first) AS other FROM shorter GROUP BY n, i, key HAVING count(*) > 1),
near AS (
  SELECT words, min(other) AS near FROM (
    SELECT s.words, r.other FROM shorter s JOIN replaced r USING (n, i, key) WHERE r.other < s.first
    UNION ALL
    SELECT s.words, l.first FROM shorter s JOIN long_lines l ON s.key = md5(array_to_string(l.words, ' ')) AND l.n = s.n - 1 WHERE l.first < s.first
    UNION ALL
    SELECT l.words, s.first FROM shorter s JOIN long_lines l ON s.key = md5(array_to_string(l.words, ' ')) AND l.n = s.n - 1 WHERE s.first < l.first)
  GROUP BY words),
judged AS (
  SELECT l.doc_id, l.v, l.line, d.first < {'doc_id': l.doc_id, 'v': l.v, 'line': l.line} AS equal_before,
         coalesce(n.near < {'doc_id': l.doc_id, 'v': l.v, 'line': l.line}, false) AS near_before
  FROM lines l JOIN distinct_lines d USING (words) LEFT JOIN near n USING (words)),
gone AS (
  SELECT doc_id, v, list(DISTINCT line) AS gone, count(DISTINCT line) FILTER (NOT equal_before) AS n_near FROM judged WHERE equal_before OR near_before GROUP BY doc_id, v)
SELECT r.doc_id, coalesce(len(parts), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed, coalesce(n_near, 0)::BIGINT AS n_near,
       md5(CASE WHEN gone IS NULL THEN text ELSE array_to_string([parts[i] FOR i IN range(1, len(parts) + 1) IF NOT list_contains(gone, i - 1)], chr(10)) END) AS left_md5
FROM raw r LEFT JOIN gone g ON g.doc_id IS NOT DISTINCT FROM r.doc_id AND g.v = r.v
"""
