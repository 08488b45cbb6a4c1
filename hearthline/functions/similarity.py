"""Token-sort similarity of short texts, from built-in column functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits per word in the longest-common-subsequence computation. Two words plus a carry have to fit a
# signed 64-bit integer.
WORD = 61
WORD_MASK = (1 << WORD) - 1


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position.cast("int"))


def token_sort_key(text: Column, case_insensitive: bool = True) -> Column:
    """Whitespace-separated tokens in code-point order, joined by one blank.

    With `case_insensitive`, letters are lower-cased and every character that is neither letter,
    digit nor underscore counts as a blank first.
    """
    if case_insensitive:
        text = F.regexp_replace(F.lower(text), r"(?U)\W", " ")
    tokens = F.array_remove(F.split(text, r"(?U)\s+"), "")
    return F.array_join(F.sort_array(tokens), " ")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two non-empty strings of any length.

    The shorter text is held as words of bits, one bit per character; each character of the longer text
    updates them with one addition per word, so the work grows with len(a) * len(b) / WORD. Texts of one
    word, the usual case, do without the list of words and the carry between them.
    """
    a_is_shorter = F.length(a) <= F.length(b)
    short = F.when(a_is_shorter, a).otherwise(b)
    long = F.when(a_is_shorter, b).otherwise(a)

    def occurrences(chunk: Column, char: Column) -> Column:
        """Bit i is set where the chunk, read backwards, has the character i places from its end."""
        zeros = F.repeat(F.lit("0"), F.length(chunk))
        ones = F.call_function("translate", chunk, F.concat(char, chunk), F.concat(F.lit("1"), zeros))
        return F.conv(ones, 2, 10).cast("bigint")

    def add_word(state: Column, masks: Column) -> Callable[[Column, Column], Column]:
        def step(acc: Column, w: Column) -> Column:
            word, mask = F.get(state, w), F.get(masks, w)
            total = word + word.bitwiseAND(mask) + acc["carry"]
            updated = total.bitwiseAND(F.lit(WORD_MASK)).bitwiseOR(word.bitwiseAND(F.bitwise_not(mask)))
            return F.struct(
                F.shiftright(total, WORD).alias("carry"),
                F.concat(acc["words"], F.array(updated)).alias("words"),
            )

        return step

    def consume(state: Column, masks: Column) -> Column:
        start = F.struct(
            F.lit(0).cast("bigint").alias("carry"),
            F.array().cast("array<bigint>").alias("words"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(state) - 1), start, add_word(state, masks), lambda acc: acc["words"]
        )

    def matched(words: Column, chunks: Column) -> Column:
        per_word = F.transform(
            words,
            lambda word, w: F.bit_count(
                F.bitwise_not(word).bitwiseAND(_bit(F.length(F.get(chunks, w))) - F.lit(1).cast("bigint"))
            ),
        )
        return F.aggregate(per_word, F.lit(0), lambda acc, n: acc + n)

    def run(chunks: Column) -> Column:
        masks = F.transform(F.split(long, ""), lambda ch: F.transform(chunks, lambda c: occurrences(c, ch)))
        start = F.transform(chunks, lambda _: F.lit(WORD_MASK))
        return F.aggregate(masks, start, consume, lambda words: matched(words, chunks))

    def one_word(chunk: Column) -> Column:
        masks = F.transform(F.split(long, ""), lambda ch: occurrences(chunk, ch))
        word = F.aggregate(
            masks,
            F.lit(WORD_MASK),
            lambda w, m: (w + w.bitwiseAND(m)).bitwiseAND(F.lit(WORD_MASK)).bitwiseOR(w.bitwiseAND(F.bitwise_not(m))),
        )
        return F.bit_count(F.bitwise_not(word).bitwiseAND(_bit(F.length(chunk)) - F.lit(1).cast("bigint")))

    starts = F.sequence(F.lit(1), F.length(short), F.lit(WORD))
    many_words = _bind(F.transform(starts, lambda s: F.reverse(F.substring(short, s, F.lit(WORD)))), run)
    return F.when(F.length(short) <= WORD, _bind(F.reverse(short), one_word)).otherwise(many_words)


def key_ratio(a: Column, b: Column) -> Column:
    """Similarity 0-100 of two token-sort keys: 200 * LCS / (len(a) + len(b))."""
    total = F.length(a) + F.length(b)
    return (
        F.when(a == b, F.lit(100.0))
        .when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0))
        .otherwise(F.lit(200.0) * lcs_length(a, b) / total)
    )


def token_sort_ratio(a: Column, b: Column, case_insensitive: bool = True) -> Column:
    """Similarity 0-100 of two texts regardless of token order."""
    keys = F.struct(
        token_sort_key(a, case_insensitive).alias("a"),
        token_sort_key(b, case_insensitive).alias("b"),
    )
    return _bind(keys, lambda k: key_ratio(k["a"], k["b"]))


# --- Exact candidate signatures -------------------------------------------------------------------
#
# Two keys a, b (len(a) <= len(b)) score at least t only if
#     d = len(a) + len(b) - 2 * LCS <= (100 - t) / 100 * (len(a) + len(b)).
# Each of the d unmatched characters can spoil one of the disjoint chunks a is cut into, so of any d + 1
# chunks at least one occurs unchanged in b. Chunks are cut a little shorter than that needs, which
# leaves a choice of which to use: the rarest. Where the threshold is so low that a has fewer characters
# than the chunks needed, every character is a chunk, and a positive score shares one.
# The small addend keeps rounding from ever lowering a bound; raising it only costs extra candidates.
_EPS = 1e-9


def longest_partner(length: Column, threshold: float) -> Column:
    """Greatest length a key of this length can be similar to."""
    return F.floor(length * (200.0 - threshold) / threshold + _EPS).cast("int")


def chunks_needed(length: Column, threshold: float) -> Column:
    """How many disjoint chunks of a key make sure that a similar key contains one of them."""
    reach = length + longest_partner(length, threshold)
    return F.floor(reach * (100.0 - threshold) / 100.0 + _EPS).cast("int") + 1


def _chunk_size(length: Column, threshold: float) -> Column:
    longest = F.floor(length / chunks_needed(length, threshold)).cast("int")
    return F.when(longest >= 3, longest - 1).otherwise(F.greatest(F.lit(1), longest))


def key_chunks(key: Column, threshold: float) -> Column:
    """Disjoint chunks of a non-empty key, in order."""
    n = F.length(key)
    size = _chunk_size(n, threshold)
    return F.transform(
        F.sequence(F.lit(0), F.floor(n / size).cast("int") - 1), lambda i: F.substring(key, i * size + 1, size)
    )


def key_grams(key: Column, threshold: float) -> Column:
    """Distinct substrings of a non-empty key that can equal a chunk of a shorter similar key."""
    n = F.length(key)
    shortest = F.greatest(F.lit(1), F.ceil(n * threshold / (200.0 - threshold) - _EPS).cast("int"))
    sizes = F.array_distinct(F.transform(F.sequence(shortest, n), lambda m: _chunk_size(m, threshold)))
    grams = F.transform(
        sizes,
        lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda p: F.substring(key, p, size)),
    )
    return F.array_distinct(F.flatten(grams))


def similar_keys(a: Column, b: Column, threshold: float) -> Column:
    """`key_ratio(a, b) >= threshold`, deciding most pairs without the subsequence.

    With d the number of unmatched characters, levenshtein <= d <= 2 * levenshtein, and characters that
    the other key lacks altogether are all unmatched.
    """
    la, lb = F.length(a), F.length(b)
    allowed = F.floor((la + lb) * (100.0 - threshold) / 100.0 + _EPS).cast("int")
    edits = F.call_function("levenshtein", a, b, allowed)  # -1 beyond the allowed number
    close_lengths = F.greatest(la, lb) <= longest_partner(F.least(la, lb), threshold)
    alien = F.length(F.call_function("translate", a, b, F.lit(""))) + F.length(F.call_function("translate", b, a, F.lit("")))
    decided = (edits * 2 <= allowed) | ((alien <= allowed) & (key_ratio(a, b) >= threshold))
    return (a == b) | ((la > 0) & (lb > 0) & close_lengths & (edits >= 0) & decided)
