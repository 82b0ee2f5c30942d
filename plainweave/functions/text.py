"""Text expressions: trimming, tokens, normalisation, n-grams, sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All Unicode white space. Java's \s and trim() know only the ASCII part.
SPACE = r"\x09-\x0d\x1c-\x1f\x85\p{Z}"
# The second branch is only tried where no word starts.
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^{SPACE}]"
WORD = r"[\p{L}\p{N}_]+"
SENTENCE = r"[^.!?]*[.!?]+|[^.!?]+$"

# Steps of the public mteval-v13a tokenisation: literal replacements first, then
# patterns that set punctuation apart. Turning line breaks into spaces, and
# setting spaces themselves apart, is left out: runs of white space are joined
# anyway. The classes list single characters, which Java looks up in one bit
# set; ranges would be tried one after the other at every character.
_LITERALS = [("<skipped>", ""), ("-\n", ""), ("&quot;", '"'), ("&amp;", "&"),
             ("&lt;", "<"), ("&gt;", ">")]
_PATTERNS = [
    (r"""([!"#$%&()*+/:;<=>?@\[\\\]^_`{|}~])""", " $1 "),
    (r"([^0123456789])([.,])", "$1 $2 "),
    (r"([.,])([^0123456789])", " $1 $2"),
    (r"([0123456789])(-)", "$1 $2 "),
]


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def tokens(c: Column) -> Column:
    """Words and single punctuation marks, as array<string>."""
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def sentences(c: Column) -> Column:
    """Trimmed, non-empty sentences, split after . ! or ?"""
    found = F.regexp_extract_all(c, F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(found, strip), lambda s: F.length(s) > 0)


def first_sentence(c: Column) -> Column:
    return strip(F.regexp_extract(c, SENTENCE, 0))


def _spaced(c: Column) -> Column:
    """Lower-cased text with punctuation set apart."""
    out = F.lower(c)
    for old, new in _LITERALS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.concat(F.lit(" "), out, F.lit(" "))
    for pattern, new in _PATTERNS:
        out = F.regexp_replace(out, pattern, new)
    return out


def normal_tokens(c: Column) -> Column:
    """Tokens as the score counts them; an empty text has one empty token."""
    found = F.regexp_extract_all(_spaced(c), F.lit(rf"[^{SPACE}]+"), F.lit(0))
    return F.coalesce(F.nullif(found, F.array().cast("array<string>")), F.array(F.lit("")))


def normalise(c: Column) -> Column:
    """Those tokens as text, joined by one space."""
    return F.array_join(normal_tokens(c), " ")


def gram_rows(toks: Column, max_n: int) -> Column:
    """One struct per token: the 1..max_n-grams that start there, null past the
    end. Built by shifting the list, so the cost is linear in its length."""
    shifted = [toks] + [
        F.slice(toks, k + 1, F.greatest(F.size(toks) - k, F.lit(0))) for k in range(1, max_n)
    ]
    return F.arrays_zip(*[t.alias(f"t{k}") for k, t in enumerate(shifted)])


def gram_stack(max_n: int) -> Column:
    """(n, gram) for every gram of one such struct's fields."""
    out: list[Column] = []
    gram = None
    for k in range(max_n):
        t = F.col(f"t{k}")
        gram = t if gram is None else F.concat(gram, F.lit(" "), t)
        out += [F.lit(k + 1), gram]
    return F.stack(F.lit(max_n), *out)
