"""Text cleaning as Column -> Column functions; every step stays in the JVM.

Word characters and white space are spelled out as character classes. Java's own ``\\w``, ``\\b``
and ``\\s`` are ASCII unless flagged, and the flagged forms differ from the usual definition
(letter, number or underscore) in marks and superscripts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .wordlists import ASCII_SPELLING, REMOVED_MARKERS, REMOVED_TOKENS

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
# single characters below 256 are one table lookup in Java, ranges are not
SPACE_SET = (r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x20\x85\xA0"
             r"\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000")
SPACE = f"[{SPACE_SET}]"
NOT_SPACE = f"[^{SPACE_SET}]"
LATIN_WORD = r"[a-zA-ZÀ-ÿ]+"
WHITESPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(
    chr(c) for c in [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def _all_but(*kept: str) -> str:
    """Character class of everything but the given characters and ranges ('az' is a to z).

    The same as a negated class, which Java matches several times slower once it has more than a
    few parts.
    """
    spans = sorted((ord(k[0]), ord(k[-1])) for k in kept)
    parts, start = [], 0
    for low, high in spans:
        if start < low:
            parts.append(rf"\x{{{start:X}}}-\x{{{low - 1:X}}}")
        start = max(start, high + 1)
    return "[" + "".join([*parts, rf"\x{{{start:X}}}-\x{{10FFFF}}"]) + "]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Drop white space of any kind at both ends (``trim`` alone drops only spaces)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither null nor empty; '' when there is none."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


# --- accents and transliteration ---------------------------------------------------------------


@lru_cache(maxsize=8)
def _fold_tables(form: str, spelled: bool = False) -> tuple[str, str, tuple]:
    """Character tables for dropping accents, generated from the Unicode database.

    Returns the ``translate`` pair (characters without a counterpart are deleted) and the
    characters that become several. With ``spelled`` the ASCII spellings take precedence.
    """
    spellings = ASCII_SPELLING if spelled else {}
    one = {c: t for c, t in spellings.items() if len(t) == 1}
    several = {c: t for c, t in spellings.items() if len(t) > 1}
    dropped = []
    for code in range(0x80, 0x110000):
        char = chr(code)
        if unicodedata.category(char) in ("Cn", "Co", "Cs"):
            continue
        base = "".join(x for x in unicodedata.normalize(form, char) if not unicodedata.combining(x))
        if base == char or char in spellings:
            continue
        if not base:
            dropped.append(char)
        elif len(base) == 1:
            one[char] = base
        else:
            several[char] = base
    return "".join([*one, *dropped]), "".join(one.values()), tuple(several.items())


def _bound(c: Column | str, fn) -> Column:
    """``fn(c)`` where ``c`` is computed once, however often ``fn`` names it."""
    return F.transform(F.array(_col(c)), fn)[0]


def _ranges(chars: Iterable[str]) -> str:
    """Character class of the given characters, in ranges."""
    codes, parts = sorted(map(ord, chars)), []
    for code in codes:
        if parts and code == parts[-1][1] + 1:
            parts[-1][1] = code
        else:
            parts.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in parts) + "]"


def _fold(c: Column | str, form: str, spelled: bool) -> Column:
    """Each step is guarded by a character class, so plain ASCII texts are passed through, and the
    characters that become several are looked for only where they are.

    Few texts hold such characters. Those texts are taken apart, and the n-th letter of each
    character's counterpart comes from the n-th of a row of ``translate`` tables.
    """
    source, target, several = _fold_tables(form, spelled)
    common = {p: q for p, q in several if p in "ßæœ"}
    rest = {p: q for p, q in several if p not in common}
    hangul = {p: q for p, q in rest.items() if "\uac00" <= p <= "\ud7a3"}
    others = {p: q for p, q in rest.items() if p not in hangul}

    def spread(char: Column, table: dict[str, str]) -> Column:
        parts = []
        for n in range(max(map(len, table.values()))):
            having = [p for p in table if len(table[p]) > n]
            lacking = [p for p in table if len(table[p]) <= n]
            parts.append(F.translate(char, "".join(having + lacking),
                                     "".join(table[p][n] for p in having)))
        return F.concat(*parts)

    def widen(x: Column) -> Column:
        for p, q in common.items():
            x = F.when(F.contains(x, F.lit(p)), F.replace(x, F.lit(p), F.lit(q))).otherwise(x)
        if not rest:
            return x
        unusual, marked = _all_but("\x00\x7f", "ÀÖ", "Øö", "øÿ"), _ranges(rest)
        syllable = lambda k: k.between("\uac00", "\ud7a3")
        return _bound(x, lambda y: F.when(
            y.rlike(unusual) & y.rlike(marked), F.array_join(F.transform(
                F.split(y, ""), lambda k: F.when(k <= "\u009f", k).when(syllable(k), spread(k, hangul))
                .when(k.rlike(marked), spread(k, others)).otherwise(k)), "")).otherwise(y))

    def fold(x: Column) -> Column:
        return F.when(x.rlike(r"[^\x00-\x7F]"), F.translate(widen(x), source, target)).otherwise(x)

    return _bound(c, fold)


def remove_accents(c: Column | str, form: str = "NFKD") -> Column:
    """Decompose and drop combining marks; case and unaccented letters stay."""
    return _fold(c, form, spelled=False)


def lowercase_unidecode(c: Column | str, lowered: bool = False) -> Column:
    """Lower case, then ASCII spelling of Latin letters and common signs.

    Letters of other scripts are kept; remaining signs (emoji, loose marks) are dropped.
    ``lowered`` says that the text is in lower case already.
    """
    folded = _fold(_col(c) if lowered else F.lower(_col(c)), "NFKD", spelled=True)
    # the plain class comes first: it is what nearly every character fails at
    return F.regexp_replace(folded, r"[^\x00-\x7F](?<![\p{L}\p{N}])", "")


# --- pattern removals -------------------------------------------------------------------------


def remove_urls(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), f"http{NOT_SPACE}+ *", ""))


def strip_links(c: Column | str) -> Column:
    """Links become one blank (the form used before classifying)."""
    return F.regexp_replace(_col(c), f"http{NOT_SPACE}+|www{NOT_SPACE}+", " ")


def remove_tweet_marking(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), f"[@#]{NOT_SPACE}+ *", ""))


def remove_html_tags(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), r"<[^\n]*?> *", ""))


def remove_punctuation(c: Column | str) -> Column:
    # The punctuation set; a backslash counts only in front of a closing bracket.
    blanked = F.regexp_replace(
        _col(c), r"""\\\)|[()!"#$%&'*+,\-./:;<=>?@\[\]^_`{}~|\r\n]""", " "
    )
    return strip(F.regexp_replace(blanked, " {2,}", " "))


def remove_repeated_words(c: Column | str) -> Column:
    """One pass: 'a a' -> 'a', 'a a a' -> 'a a'."""
    return F.regexp_replace(
        _col(c), rf"(?<!{WORD})({WORD}+){SPACE}+\1(?!{WORD})", "$1"
    )


def collapse_chars(c: Column | str, max_repetition: int = 2) -> Column:
    return F.regexp_replace(
        _col(c), rf"([^\n])\1{{{max_repetition},}}", "$1" * max_repetition
    )


def collapse_vowels(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"([aeiou])\1+", "$1")


def remove_short_words(c: Column | str, n: int) -> Column:
    return strip(F.regexp_replace(_col(c), rf"(?<!{WORD}){WORD}{{1,{n}}}(?!{WORD}) ?", ""))


def remove_numbers(c: Column | str, mode: str = "replace") -> Column:
    """``replace`` drops the digits, ``filter`` empties any text that has one."""
    if mode == "filter":
        return _bound(c, lambda x: F.when(x.rlike("[0-9]"), F.lit("")).otherwise(x))
    if mode == "replace":
        return F.regexp_replace(_col(c), "[0-9] *", "")
    raise ValueError(f"unknown mode {mode!r}")


def remove_gerund(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), rf"ndo(?!{WORD})", "")


def remove_infinitive(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), rf"r(?!{WORD})", "")


def squeeze_spaces(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), f"{SPACE}+", " "))


# --- tokens and stop words --------------------------------------------------------------------


def tokens(c: Column | str) -> Column:
    """Split on white space, no empty tokens."""
    return F.array_remove(F.split(_col(c), f"{SPACE}+"), "")


def extract_words(c: Column | str, min_length: int = 1) -> Column:
    found = F.regexp_extract_all(F.lower(_col(c)), F.lit(f"({LATIN_WORD})"))
    return found if min_length <= 1 else F.filter(found, lambda t: F.length(t) >= min_length)


def extract_hashtags(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(f"(#{WORD}+)"))


def remove_stopwords(c: Column | str, words: Sequence[str]) -> Column:
    """Drop whole words (case sensitive) together with the spaces after them.

    Plain words are looked up in a hash set per token, so the cost does not grow with the list.
    Entries holding other characters (a hyphen, a blank) are removed by pattern first.
    """
    plain = sorted({w for w in words if re.fullmatch(r"\w+", w)})
    phrases = sorted({w for w in words if w and not re.fullmatch(r"\w+", w)})
    c = _col(c)
    if phrases:
        options = "|".join(rf"\Q{w}\E" for w in phrases)
        # a word boundary on both sides, whichever kind of character the entry starts with
        edge = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
        c = F.regexp_replace(c, f"{edge}(?:{options}){edge} *", "")
    if plain:
        pieces = F.regexp_extract_all(c, F.lit(f"({WORD}+ *|{NOT_WORD}+)"))
        kept = F.filter(pieces, lambda t: ~F.rtrim(t).isin(plain))
        c = F.array_join(kept, "")
    return strip(c)


def drop_tokens(c: Column | str, words: Sequence[str] = REMOVED_TOKENS) -> Column:
    """White-space tokens that equal one of the words in lower case are dropped."""
    return F.array_join(F.filter(tokens(c), lambda t: ~F.lower(t).isin(list(words))), " ")


def drop_non_ascii_tokens(c: Column | str) -> Column:
    ascii_only = F.filter(tokens(F.lower(_col(c))), lambda t: t.rlike(r"^[\x00-\x7F]+$"))
    return F.array_join(ascii_only, " ")


def name_words(name: str, min_length: int = 2) -> list[str]:
    """Words of an entity name, the stop words that stand for the entity itself."""
    return [w for w in re.findall(LATIN_WORD, name.lower()) if len(w) >= min_length]


def strip_name_tokens(c: Column | str, name: Column | str) -> Column:
    """Remove the words of the entity's own name, given per row, from a cleaned text."""
    kept = _bound(extract_words(name, 2), lambda own: F.filter(
        tokens(c), lambda t: ~F.array_contains(own, t)))
    return F.array_join(kept, " ")


# --- joining and markers ----------------------------------------------------------------------


def join_text(*parts: Column | str) -> Column:
    """Strip each part, leave out the blank ones, join by a blank; nothing left -> null."""
    stripped = F.array(*[strip(p) for p in parts])
    return blank_to_null(F.array_join(F.filter(stripped, lambda p: p != ""), " "))


def join_text_list(c: Column | str) -> Column:
    """``join_text`` over the items of an array column."""
    stripped = F.transform(_col(c), strip)
    return blank_to_null(F.array_join(F.filter(stripped, lambda p: p != ""), " "))


def join_list_text(c: Column | str) -> Column:
    """Items of an array that are neither null nor empty, joined by a blank; null -> ''."""
    return F.coalesce(F.array_join(F.filter(_col(c), lambda p: p != ""), " "), F.lit(""))


def concat_columns(*cols: Column | str) -> Column:
    """Join by a blank with null as '', so the blanks between columns always stay."""
    return F.concat_ws(" ", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def clear_removed_marker(c: Column | str) -> Column:
    stripped = strip(F.coalesce(_col(c), F.lit("")))
    return _bound(
        stripped, lambda x: F.when(F.lower(x).isin(REMOVED_MARKERS), F.lit("")).otherwise(x))


def strip_nul(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit("\x00"), F.lit(""))


def strip_nul_json(c: Column | str) -> Column:
    """Drop NUL from every string of a JSON text, at any depth (it is written as an escape).

    An escaped backslash in front of ``u0000`` is text, not a NUL: pairs of backslashes are kept.
    """
    return F.regexp_replace(_col(c), r"(?<!\\)((?:\\\\)*)\\u0000", "$1")


# --- names and keys ---------------------------------------------------------------------------


def same_name(a: Column | str, b: Column | str) -> Column:
    """Equal when case, accents and outer space are left out."""
    return name_key(a) == name_key(b)


def name_key(c: Column | str) -> Column:
    return remove_accents(F.lower(strip(c)))


def slugify(c: Column | str) -> Column:
    ascii_only = F.regexp_replace(remove_accents(c), r"[^\x00-\x7F]", "")
    return F.lower(F.btrim(F.regexp_replace(ascii_only, "[^a-zA-Z0-9]+", "_"), F.lit("_")))


def slug(c: Column | str) -> Column:
    """Folder name that keeps accents; empty -> 'sem_nome'."""
    letters = _all_but("az", "09", *"áàâãéêíóôõúüç_-", *WHITESPACE)
    kept = F.regexp_replace(F.lower(strip(c)), letters, "")
    joined = F.regexp_replace(kept, f"{SPACE}+", "_")
    return F.coalesce(blank_to_null(joined), F.lit("sem_nome"))


def alnum_slug(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]", "_")


def normalize_target(c: Column | str) -> Column:
    """Channel key: stripped, without a leading 'r/', '' -> null."""
    return blank_to_null(F.regexp_replace(strip(c), "^r/", ""))


def signature_text(c: Column | str, size: int = 60) -> Column:
    """First characters of the text without punctuation; equal for near copies."""
    kept = F.regexp_replace(F.lower(_col(c)), _all_but("az", "09", "Àÿ", *WHITESPACE), "")
    return F.substring(squeeze_spaces(kept), 1, size)


def term_variants(c: Column | str) -> Column:
    """A search term with and without accents; terms of several words in double quotes."""
    both = _bound(strip(c), lambda term: F.array_distinct(
        F.array(term, remove_accents(term, "NFD"))))

    def quoted(v: Column) -> Column:
        done = v.startswith('"') & v.endswith('"')
        return F.when(v.contains(" ") & ~done, F.concat(F.lit('"'), v, F.lit('"'))).otherwise(v)

    return F.transform(both, quoted)


def capitalize(c: Column | str) -> Column:
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))


def numbered(prefix: Column | str, number: Column | str, width: int) -> Column:
    """``prefix_0007``: zero padded, longer numbers are kept whole."""
    number = _col(number).cast("string")
    padded = F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))
    return F.concat(_col(prefix), F.lit("_"), padded)


def yes_no(c: Column | str) -> Column:
    return F.when(_col(c), F.lit("SIM")).otherwise(F.lit("NÃO"))


def network_of(collection: Column | str) -> Column:
    """Social network named in a collection's name, else the name itself."""
    c = _col(collection)
    low = F.lower(c)
    return (
        F.when(low.contains("youtube"), F.lit("youtube"))
        .when(low.contains("reddit"), F.lit("reddit"))
        .when(low.contains("meta"), F.lit("meta"))
        .otherwise(c)
    )


def watch_url(video_id: Column | str) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), _col(video_id))


def permalink_url(permalink: Column | str) -> Column:
    return F.concat(F.lit("https://reddit.com"), blank_to_null(permalink))


def join_tags(c: Column | str) -> Column:
    return F.coalesce(F.array_join(_col(c), ","), F.lit(""))


# --- compositions -----------------------------------------------------------------------------


def vectorizer_normalize(c: Column | str, vowels: bool = False) -> Column:
    folded = remove_accents(F.lower(_col(c)))
    return collapse_vowels(folded) if vowels else folded


def classifier_text(c: Column | str) -> Column:
    """Text as the sentiment classifier sees it."""
    return squeeze_spaces(strip_links(c))


def preprocess(c: Column | str, stopwords: Sequence[str], lemma=None, short: int = 3) -> Column:
    """The full cleaning chain; ``lemma`` is an optional Column -> Column step after lower case."""
    text = F.lower(_col(c))
    if lemma is not None:
        text = lemma(text)
    # lemma tokens are joined by single blanks, so white space is squeezed with or without one
    text = squeeze_spaces(text)
    text = remove_stopwords(text, stopwords)
    text = lowercase_unidecode(text, lowered=lemma is None)
    text = remove_stopwords(text, stopwords)
    text = remove_tweet_marking(text)
    text = collapse_chars(text)
    text = remove_urls(text)
    text = remove_punctuation(text)
    text = remove_numbers(text)
    text = remove_short_words(text, short)
    return F.coalesce(text, F.lit(""))
