"""Fill-in-the-middle texts: units are counted and selected eight bytes at a time.

A row's UTF-8 is laid out in 64-bit words of its own and read as ``uint64``. Arithmetic on whole words marks the
byte that ends each unit, a bit count per word and its running sum tell in which word the k-th unit ends, and a
byte-wise prefix sum inside that one word tells where.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.columns import apart
from goldenrec.llm.words import Slice, slices

# The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Of 100 texts so many are cut, and of 100 cut ones so many have the suffix first.
CUT_PERCENT = 90
SPM_PERCENT = 20

OWN = ("n", "form", "prefix", "middle", "suffix", "output", "_text", "_low", "_high", "_h", "_cuts")

_U = np.uint64
_ONES = _U(0x0101010101010101)
_HIGH = _U(0x8080808080808080)
_SEVEN = _U(0x7F7F7F7F7F7F7F7F)
_CASE = _U(0x2020202020202020)


def _aligned(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows as little-endian words, each row from a word of its own and with a zero byte behind it.

    Returns the words, the first word of every row (and the end), and the length of every row.
    """
    length = np.diff(part.offsets)
    first = np.concatenate([[0], np.cumsum(length // 8 + 1)])
    laid = np.zeros(first[-1] * 8, np.uint8)
    shift = np.repeat(first[:-1] * 8 - part.offsets[:-1], length)
    laid[np.arange(len(part.data)) + shift] = part.data
    return laid.view("<u8").astype(_U, copy=False), first, length


def _letters(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that is an ASCII letter."""
    low = (words & _SEVEN) | _CASE
    # adding lifts a byte over 0x7F if it is at least the limit; seven bits never carry into the next byte
    from_a = low + _ONES * _U(0x80 - ord("a"))
    after_z = low + _ONES * _U(0x80 - ord("z") - 1)
    return from_a & ~after_z & ~words & _HIGH


def unit_ends(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Words with the high bit of every byte that ends a unit, and the first word of every row (and the end).

    A unit is a run of ASCII letters or one other code point: a byte goes on if it and the next are letters, or
    if the next continues its code point.
    """
    words, first, length = _aligned(part)
    following = np.zeros(len(words) + 1, _U)
    following[: len(words)] = words
    after = (words >> _U(8)) | (following[1:] << _U(56))
    goes_on = (_letters(words) & _letters(after)) | (after & ~(after << _U(1)) & _HIGH)
    ends = ~goes_on & _HIGH
    # the bytes behind a row are none of its own: its last word keeps the first length % 8
    last = first[1:] - 1
    keep = (_U(1) << (_U(8) * (length % 8).astype(_U))) - _U(1)
    ends[last] &= keep
    return ends, first


def select(ends: np.ndarray, before: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Byte behind the mark number ``rank`` (from 1), counted over all words; ``before`` is the running count."""
    word = np.searchsorted(before[1:], rank, "left")
    inside = (rank - before[word]).astype(_U)
    # byte j of the product holds the number of marks in bytes 0 .. j, at most 8
    running = (ends[word] >> _U(7)) * _ONES
    reached = ((running | _HIGH) - inside * _ONES) & _HIGH
    return 8 * word + 9 - np.bitwise_count(reached).astype(np.int64)


def cut_rows(part: Slice, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of every row, and the byte offsets behind ``draws % (units + 1)`` units, smaller one first."""
    ends, first = unit_ends(part)
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(ends), dtype=np.int64)])
    units = before[first[1:]] - before[first[:-1]]
    ranks = np.sort(draws % (units + 1)[:, None], axis=1)
    cuts = np.zeros(ranks.shape, np.int64)
    row, side = np.nonzero(ranks)
    if len(row):
        place = select(ends, before, before[first[row]] + ranks[row, side])
        cuts[row, side] = place - 8 * first[row]
    return units, cuts


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last three columns (text, low draw, high draw) become units and the two cuts; the others pass."""
    for batch in batches:
        text, *draws = batch.columns[-3:]
        drawn = np.stack([np.asarray(column) for column in draws], axis=1)
        for part in slices(text):
            here = slice(part.first, part.first + part.rows)
            units, cuts = cut_rows(part, drawn[here])
            rows = batch.slice(part.first, part.rows)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-3], text.slice(part.first, part.rows), *map(pa.array, (units, cuts[:, 0], cuts[:, 1]))],
                [*rows.schema.names[:-3], "_text", "n", "_low", "_high"],
            )


def _draws(doc_id: Column) -> Column:
    """The first four 32-bit numbers of the SHA-256 of ``1:`` and the id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def _marked(form: Column, prefix: Column, middle: Column, suffix: Column, text: Column) -> Column:
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``n, form, prefix, middle, suffix, output``: each text cut into three and put in a new order.

    The text's n units (runs of ASCII letters, or single other code points) are cut behind two drawn counts. Texts
    that are empty or hold one of the marks, and those whose third draw says so, are ``plain``: the output is the
    text, and the parts are NULL. The others are ``psm`` or ``spm`` by the fourth draw. All draws come from the
    SHA-256 of doc_id alone, so reruns, copies of a row and other partitions give the same.

    NULL text: as empty. NULL doc_id: drawn as for an id without digits. Repeated rows stay and get the same result;
    other columns pass through, and columns called like a result are replaced. There is no shuffle; memory is bounded by one text.
    """
    docs, restored = apart(docs.drop("n", "form", "prefix", "middle", "suffix", "output"), OWN)
    names = [name for name in docs.columns if name.lower() != "text"]
    drawn = docs.withColumn("_h", _draws(F.col("doc_id")))
    source = drawn.select(
        *names, "_h", F.col("text").alias("_text"), F.get("_h", 0).alias("_low"), F.get("_h", 1).alias("_high")
    )
    given = source.drop("_text", "_low", "_high").schema
    for name, kind in (("_text", "string"), ("n", "long"), ("_low", "long"), ("_high", "long")):
        given = given.add(name, kind)
    found = source.mapInArrow(_cut_texts, given)
    text, low, high = F.coalesce("_text", F.lit("")), F.col("_low").cast("int"), F.col("_high").cast("int")
    held = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains(text, F.lit(mark))
    plain = (F.col("n") == 0) | held | (F.get("_h", 2) % 100 >= CUT_PERCENT)
    form = F.when(plain, "plain").when(F.get("_h", 3) % 100 < SPM_PERCENT, "spm").otherwise("psm")
    data = text.cast("binary")

    def part(start: Column, size: Column) -> Column:
        return F.when(F.col("form") != "plain", F.substring(data, start + 1, size).cast("string"))

    cut = found.withColumn("form", form).withColumns(
        {
            "prefix": part(F.lit(0), low),
            "middle": part(low, high - low),
            "suffix": part(high, F.octet_length(text) - high),
        }
    )
    result = cut.withColumn("output", _marked(F.col("form"), F.col("prefix"), F.col("middle"), F.col("suffix"), text))
    shown = [F.col("_text").alias("text") if name.lower() == "text" else F.col(name) for name in docs.columns]
    return restored(result.select(*shown, "n", "form", "prefix", "middle", "suffix", "output"))


def restore(output: Column, form: Column) -> Column:
    """The text again, from an output and its form alone.

    No mark begins where another ends, so a mark that no part holds cannot arise where a part and a mark meet.
    """
    before = F.substring_index(output, MIDDLE, 1)
    middle = F.substr(output, F.length(before) + len(MIDDLE) + 1)
    psm_prefix = F.substr(F.substring_index(before, SUFFIX, 1), F.lit(len(PREFIX) + 1))
    psm_suffix = F.substr(before, F.length(F.substring_index(before, SUFFIX, 1)) + len(SUFFIX) + 1)
    spm_suffix = F.substr(F.substring_index(before, PREFIX, 1), F.lit(len(SUFFIX) + 1))
    spm_prefix = F.substr(before, F.length(F.substring_index(before, PREFIX, 1)) + len(PREFIX) + 1)
    return (
        F.when(form == "psm", F.concat(psm_prefix, middle, psm_suffix))
        .when(form == "spm", F.concat(spm_prefix, middle, spm_suffix))
        .otherwise(output)
    )
