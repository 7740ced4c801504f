"""Text expressions on columns; all stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character Unicode calls white space, as Python's ``\s`` has it; Java's own class is ASCII.
BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
#: What may not stand beside a whole word: engines disagree on ``\b``.
WORD = r"[\p{L}\p{N}_]"

ACCENTS = ("àâäáãåçéèêëíîïìñóôöõòúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x: Column | str) -> Column:
    """White space collapsed to single blanks, none at the ends."""
    return F.trim(F.regexp_replace(_col(x), BLANK + "+", " "))


def nfc(x: Column | str) -> Column:
    """Unicode normal form C. Texts below U+0300 have it already; the others go through the JVM's ICU library, so no
    text leaves the JVM."""
    x = _col(x)
    return F.when(x.rlike("[^\\x{0}-\\x{2ff}]"), F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(False))).otherwise(x)


def norm_key(x: Column | str) -> Column:
    """The key under which two texts count as the same: composed (NFC), cleaned and case-folded."""
    return F.replace(F.lower(clean(nfc(x))), F.lit("ß"), F.lit("ss"))


def atom(x: Column | str) -> Column:
    """An enumeration value without accents, case and surrounding blanks."""
    return F.translate(F.lower(clean(x)), *ACCENTS)


def holdout_key(x: Column | str) -> Column:
    """The key for exact matches against held-out text: lower case, straight apostrophes, no punctuation."""
    plain = F.translate(F.lower(nfc(x)), "’‘“”«»", "''\"\"\"\"")
    return clean(F.regexp_replace(plain, r"[^\p{L}\p{N}_\s\p{Z}']", ""))


def sha(x: Column | str) -> Column:
    return F.sha2(_col(x), 256)


def unit_hash(x: Column | str) -> Column:
    """A number in [0, 1] from the first 32 bits of the SHA-256 of a key: the same draw everywhere."""
    return F.conv(F.substring(sha(x), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def words(x: Column | str) -> Column:
    """Words as white space parts them."""
    return F.filter(F.split(clean(x), " "), lambda w: w != "")


def word_count(x: Column | str) -> Column:
    return F.size(words(x))


def token_estimate(chars: Column, n_words: Column) -> Column:
    """Tokens guessed from characters and words, without a tokenizer."""
    return F.greatest(chars / 4.0, n_words * 1.35).cast("bigint")


def unix_newlines(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), r"\r\n?", "\n")


def lines(x: Column | str) -> Column:
    """Cleaned non-empty lines."""
    return F.filter(F.transform(F.split(unix_newlines(x), "\n"), clean), lambda s: s != "")


def paragraphs(x: Column | str, min_chars: int = 1, bullets: bool = False) -> Column:
    """Paragraphs between blank lines (and at bullets), cleaned, of at least ``min_chars``."""
    cut = r"\n\s*\n" + (r"|[•●]" if bullets else "")
    return F.filter(F.transform(F.split(unix_newlines(x), cut), clean), lambda s: F.length(s) >= min_chars)


def segments(x: Column | str, boilerplate: str | None = None, min_chars: int = 1) -> Column:
    """A plain text as segments: paragraphs with their hard wraps undone where a blank line parts any, else lines.
    ``boilerplate`` is a pattern of lines to leave out."""
    body = F.regexp_replace(unix_newlines(x), r"^\s+|\s+$", "")
    keep = (lambda s: ~s.rlike(boilerplate)) if boilerplate else (lambda s: F.lit(True))
    wrapped = F.transform(F.split(body, r"\n\s*\n"), lambda p: clean(F.array_join(F.filter(F.split(p, "\n"), keep), " ")))
    single = F.filter(F.transform(F.split(body, "\n"), clean), keep)
    parts = F.when(body.rlike(r"\n[^\S\n]*\n"), wrapped).otherwise(single)
    return F.filter(parts, lambda s: (F.length(s) >= min_chars) & (s != ""))


def between_markers(x: Column | str, start: str, end: str) -> Column:
    """The text between the first start marker's line and the end marker, where both stand in this order."""
    inner = F.regexp_extract(_col(x), f"(?is){start}[^\n]*(?:\n|$)(.*?){end}", 1)
    return F.when(inner != "", inner).otherwise(_col(x))


def sentences(x: Column | str, cleaned: bool = False) -> Column:
    """Sentences of the cleaned text, cut after . ! ? and a blank; ``cleaned`` spares a text that is clean a second time."""
    return F.filter(F.split(_col(x) if cleaned else clean(x), r"(?<=[.!?]) "), lambda s: s != "")


def first_sentence(x: Column | str, most: int, own: Column | None = None) -> Column:
    """The first sentence, cut at ``most`` characters; ``own`` are the text's sentences where they are at hand."""
    own = sentences(x) if own is None else own
    return F.rtrim(F.substring(F.coalesce(F.try_element_at(own, F.lit(1)), clean(x)), 1, most))


def summary(x: Column | str, most: int, count: int = 2, own: Column | None = None) -> Column:
    """The first sentences that fit into ``most`` characters; the first is cut if it alone is too long."""
    own = F.slice(sentences(x) if own is None else own, 1, count)
    fits = F.aggregate(own, F.lit(""), lambda acc, s: F.when(F.length(F.concat_ws(" ", F.nullif(acc, F.lit("")), s)) <= most, F.concat_ws(" ", F.nullif(acc, F.lit("")), s)).otherwise(acc))
    return F.when(F.size(own) == 0, F.lit("")).otherwise(F.coalesce(F.nullif(fits, F.lit("")), F.rtrim(F.substring(own[0], 1, most))))


def quoted(term: str) -> str:
    """A term as a pattern, any white space between its words."""
    return (BLANK + "+").join(re.escape(w) for w in term.lower().split())


def has_word(x: Column, term: str) -> Column:
    """Whether a term stands in a lower-case text as whole words."""
    return x.rlike(f"(?:^|[^\\p{{L}}\\p{{N}}_]){quoted(term)}(?:$|[^\\p{{L}}\\p{{N}}_])")


def has_any(text: Column, terms: Column) -> Column:
    """Whether any of an array column's terms stands in the text as whole words, without case."""
    padded = F.concat(F.lit(" "), F.lower(clean(text)), F.lit(" "))

    def inside(term: Column) -> Column:
        plain = F.lower(clean(term))
        pattern = F.concat(F.lit(r"[^\p{L}\p{N}_]"), F.regexp_replace(plain, r"([\\.\[\]{}()*+?^$|\-/])", r"\\$1"), F.lit(r"[^\p{L}\p{N}_]"))
        return (plain != "") & F.rlike(padded, pattern)

    return F.coalesce(F.exists(terms, inside), F.lit(False))


def earliest(x: Column, terms: Sequence[str]) -> Column:
    """The term that stands first in a lower-case text (ties: the lesser term); null without any."""
    spots = F.array(*[F.struct(F.instr(x, t).alias("at"), F.lit(t).alias("term")) for t in terms])
    return F.array_min(F.filter(spots, lambda s: s["at"] > 0))["term"]


def first_listed(x: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """The first pair of a list of which either term stands in a lower-case text, as a struct (left, right)."""
    out = None
    for left, right in pairs:
        hit = F.contains(x, F.lit(left)) | F.contains(x, F.lit(right))
        pair = F.struct(F.lit(left).alias("left"), F.lit(right).alias("right"))
        out = F.when(hit, pair) if out is None else out.when(hit, pair)
    return out


def replace_words(x: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Whole-word replacements without case, one after the other in the given order."""
    out = _col(x)
    for old, new in pairs:
        out = F.regexp_replace(out, f"(?iu)(?<!{WORD}){re.escape(old)}(?!{WORD})", new)
    return out


def replace_matching_case(x: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Whole-word replacements that take over the case found: UPPER, Capital or as listed."""
    out = _col(x)
    for old, new in pairs:
        edge = lambda p: f"(?<!{WORD}){p}(?!{WORD})"
        out = F.regexp_replace(out, edge(re.escape(old.upper())), new.upper())
        out = F.regexp_replace(out, edge(f"(?=\\p{{Lu}})(?iu:{re.escape(old)})"), new[:1].upper() + new[1:])
        out = F.regexp_replace(out, edge(f"(?iu:{re.escape(old)})"), new)
    return out


def slug(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(_col(x)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def letters_only(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), r"[^\p{L}\p{N}]", "")


def upper_share(x: Column | str) -> Column:
    """Share of upper case among a text's letters; 0 without letters."""
    letters = F.length(F.regexp_replace(_col(x), r"[^\p{L}]", ""))
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(_col(x), r"[^\p{Lu}]", "")), letters), F.lit(0.0))


def longest_leaves(*fields: Column, most: int = 4) -> Column:
    """The distinct non-blank fields, longest first (ties in order of text), at most ``most``, one per line."""
    own = F.array_distinct(F.filter(F.array(*[clean(f) for f in fields]), lambda s: s.isNotNull() & (s != "")))
    ranked = F.array_sort(F.transform(own, lambda s: F.struct((-F.length(s)).alias("n"), s.alias("s"))))
    return F.array_join(F.transform(F.slice(ranked, 1, most), lambda r: r["s"]), "\n")


def truthy(x: Column | str) -> Column:
    """A boolean written as text: 1 true yes y on / 0 false no n off and blank; anything else is null."""
    plain = F.lower(clean(_col(x).cast("string")))
    return F.when(plain.isin("1", "true", "yes", "y", "on"), True).when(plain.isin("0", "false", "no", "n", "off", ""), False)


def template(pattern: str, **values: Column) -> Column:
    """``{name}`` slots of a fixed pattern filled from columns."""
    out = F.lit(pattern)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


