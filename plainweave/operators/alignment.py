"""Token alignments of two texts: longest common subsequence and edit distance.

Both run on bit vectors, a block of one text's positions at a time, so the time
is the product of the lengths over the size of a machine word and the space is
linear: texts of any length are compared whole. What two texts begin and end
with together is taken off first, and few edits are found by a growing band of
diagonals. Rows are independent: nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainweave.functions.text import words

BLOCK = 8192  # positions whose bits are held at once
BAND = 64  # edits that are looked for on diagonals first, at most


def _trimmed(a: list, b: list) -> tuple[list, list, int]:
    """Both without what they begin and end with together, and its length."""
    least = min(len(a), len(b))
    head = _together(a, 0, b, 0)
    tail = 0
    while tail < least - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    return a[head : len(a) - tail], b[head : len(b) - tail], head + tail


def _together(a: list, i: int, b: list, j: int) -> int:
    """Number of equal tokens from a[i] and b[j] on, by doubling steps."""
    start, step, least = i, 8, min(len(a) - i, len(b) - j)
    done = 0
    while done < least:
        step = min(step, least - done)
        if a[i + done : i + done + step] == b[j + done : j + done + step]:
            done += step
            step *= 2
        elif step == 1:
            break
        else:
            step = max(1, step // 4)
    return i + done - start


def _blocks(a: list):
    """Per block of `a` its size and, of every token there, the bits of its places."""
    for start in range(0, len(a), BLOCK):
        masks: dict = {}
        part = a[start : start + BLOCK]
        for k, token in enumerate(part):
            masks[token] = masks.get(token, 0) | 1 << k
        yield len(part), masks


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence."""
    a, b, found = _trimmed(a, b)
    if len(a) < len(b):
        a, b = b, a
    carry = bytearray(len(b))  # from the block before, of every token of b
    for size, masks in _blocks(a):
        full = (1 << size) - 1
        v = full
        for j, token in enumerate(b):
            hit = v & masks.get(token, 0)
            total = v + hit + carry[j]
            carry[j] = total >> size
            v = (total & full) | (v & ~hit)
        found += size - v.bit_count()
    return found


def _few_edits(a: list, b: list, most: int) -> int | None:
    """The distance if it is at most `most`: on each diagonal the furthest place
    that so many edits reach."""
    goal = len(b) - len(a)
    reach = {0: _together(a, 0, b, 0)}
    for edits in range(most + 1):
        if reach.get(goal, -1) >= len(a):
            return edits
        after = {}
        for k in range(-edits - 1, edits + 2):
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
            if i < 0 or i > len(a) or i + k < 0 or i + k > len(b):
                i = min(i, len(a), len(b) - k)
                if i < 0 or i + k < 0:
                    continue
            after[k] = i + _together(a, i, b, i + k)
        reach = after
    return None


def _at_least(a: list, b: list) -> int:
    """Tokens of the longer `a` that `b` has not, copies counted: each is an edit."""
    return (Counter(a) - Counter(b)).total()


def distance(a: list, b: list) -> int:
    """Insertions, deletions and replacements that turn `a` into `b`, least."""
    a, b, _ = _trimmed(a, b)
    if not a or not b:
        return len(a) + len(b)
    if len(a) < len(b):
        a, b = b, a
    # diagonals take the square of the edits, bit vectors the shorter length for
    # every block of the longer: no more edits are looked for than that pays for
    most = min(BAND, isqrt(len(b) * -(-len(a) // BLOCK)))
    if _at_least(a, b) <= most:
        few = _few_edits(a, b, most)
        if few is not None:
            return few
    # rises and falls from column to column, on the border below each block
    rise, fall = bytearray(b"\1" * len(b)), bytearray(len(b))
    for size, masks in _blocks(a):
        full, top = (1 << size) - 1, size - 1
        up, down = full, 0
        for j, token in enumerate(b):
            equal = masks.get(token, 0)
            upright = equal | down
            equal |= fall[j]
            across = (((equal & up) + up) ^ up) | equal
            more, less = down | (full & ~(across | up)), up & across & full
            more = more << 1 | rise[j]
            less = less << 1 | fall[j]
            rise[j], fall[j] = more >> size & 1, less >> size & 1
            more, less = more & full, less & full
            up = less | (full & ~(upright | more))
            down = more & upright
    return len(a) + sum(rise) - sum(fall)


def _share(a: list, b: list) -> float:
    longer = max(len(a), len(b))
    return distance(a, b) / longer if longer else 0.0


def _of_pairs(compute, held: str, kind: T.DataType):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [None if x is None or y is None else compute(list(x), list(y)) for x, y in zip(a, b)], dtype=held
        )

    return F.pandas_udf(run, kind)


# of two columns of token lists; null if one is
common_tokens = _of_pairs(common_length, "Int64", T.LongType())
edit_distance = _of_pairs(distance, "Int64", T.LongType())
edit_share = _of_pairs(_share, "Float64", T.DoubleType())


def _lower_words(c: Column) -> Column:
    return words(F.lower(c))


def rouge_l(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Adds the precision, recall and F1 (0-100) of the longest common
    subsequence of lower-cased words. A null text has null scores; without a
    common word, as in empty texts, all are 0."""
    made = df.withColumns({"_p": _lower_words(F.col(prediction)), "_r": _lower_words(F.col(reference))})
    counted = made.withColumn("_common", common_tokens("_p", "_r"))
    n, p, r = F.col("_common"), F.size("_p"), F.size("_r")
    share = lambda size: F.when(n.isNotNull(), F.when(n > 0, 100 * n / size).otherwise(0.0))
    f1 = F.when(n.isNotNull(), F.when(n > 0, 200 * n / (p + r)).otherwise(0.0))
    return counted.withColumns({"rouge_l_precision": share(p), "rouge_l_recall": share(r), "rouge_l": f1}).drop("_p", "_r", "_common")


def edit_difference(a: Column, b: Column) -> Column:
    """Edit distance of two token lists over the longer one's length; 0 if both
    are empty. Taken in one step: the lists are made once."""
    return edit_share(a, b)
