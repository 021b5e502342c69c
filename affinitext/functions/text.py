"""Text normalisation and tokenising as native column expressions.

Word boundaries are spelled out as Unicode classes: Java's bare `\\w` and `\\b` are
ASCII-only and would change accented words.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: these decide the results and must stay as they are -----------------
UNITS = {
    "centimères carrés": "cm²",
    "millimètres carrés": "mm²",
    "décimètres carrés": "dm²",
    "mètres carrés": "m²",
    "m2": "m²",
    "mètres cubes": "m³",
    "kilomètres": "km",
    "kilomètres carrés": "km²",
    "centimètres cubes": "km³",
    "décimètres cubes": "km³",
    "kilomètres cubes": "km³",
    "kilomètres par heure": "km/h",
}
SYMBOL_LEMMAS = {
    "%": ["pourcent", "pourcents"],
    "$": ["dollar", "dollars"],
    "€": ["euro", "euros"],
}
NEGATIONS = ["n’", "n'"]
EXCLUDED_POS = ["PRON", "AUX", "DET", "PUNCT", "OTHER", "SPACE"]
STOP_LEMMAS = [
    "de", "d'", "d’", "qu’", "qu'", "que", "au", "à", "►",
    "!", '"', "#", "%", "&", "'", "(", ")", "*", "+", ",", "-", ".", "/", ":", ";",
    "<", "=", ">", "?", "@", "[", "\\", "]", "^", "_", "`", "{", "|", "}", "~",
]
LEMMA_PUNCTUATION = "!\"&'()*+,./:;<=>?@[]^_`{|}~"
UNICODE_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
STRIP_CHARS = "-,+\\/%()^*[]\"'~;:!?."
PARTY_TEXT = "Open Vld|N-VA"
PARTY_NAME = "Open VLD"
# ---------------------------------------------------------------------------------------

# A letter, digit or underscore. The letter beyond the basic plane is one of \p{L} anyway:
# naming it makes Java look behind by characters and not by halves of them.
_WORD = r"[\p{L}\p{N}_𝐀]"

TOKEN_PATTERN = (
    r"[Aa]ujourd['’]hui"
    r"|\p{N}+(?:[.,]\p{N}+)*"
    r"|(?:qu|Qu|jusqu|Jusqu|lorsqu|Lorsqu|puisqu|Puisqu|[cdjlmnstCDJLMNST])['’]"
    r"|[\p{L}\p{N}_²³]+(?:-[\p{L}\p{N}_]+)*"
    r"|[^\s\p{L}\p{N}_]"
)
PLAIN_PATTERN = r"[\p{L}\p{Nl}\p{No}_]+"
DIGITS_PATTERN = r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉]+$"


def expand_honorifics(text: Column) -> Column:
    """`M.`/`m.` at a word start become `monsieur`; `Mme` becomes `madame` anywhere."""
    # The test for the character before comes second: most places fail on the letter.
    sir = F.regexp_replace(text, rf"[Mm](?<!{_WORD}[Mm])\.", "monsieur")
    return F.replace(sir, F.lit("Mme"), F.lit("madame"))


def abbreviate_units(text: Column, units: Mapping[str, str] = UNITS) -> Column:
    """Whole-word measure names become symbols, in the order the mapping lists them.

    Texts that name no unit at all skip the chain of replacements.
    """
    mentions = F.lit(False)
    replaced = text
    for name, symbol in units.items():
        mentions = mentions | F.contains(text, F.lit(name))
        whole = rf"\Q{name}\E(?<!{_WORD}\Q{name}\E)(?!{_WORD})"
        replaced = F.regexp_replace(replaced, whole, symbol)
    return F.when(mentions, replaced).otherwise(text)


def tokenize(text: Column) -> Column:
    """French-aware tokens: elisions split off, hyphenated words and numbers kept whole."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def plain_tokens(text: Column, min_len: int = 2, max_len: int = 25) -> Column:
    """Lower-cased letter runs of `min_len` to `max_len` characters."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(PLAIN_PATTERN), F.lit(0))
    return F.filter(
        runs,
        lambda t: F.length(t).between(min_len, max_len) & ~t.startswith("_"),
    )


def strip_chars(text: Column, chars: str = STRIP_CHARS) -> Column:
    """Remove any of `chars` from both ends."""
    return F.btrim(text, F.lit(chars))


def is_number(token: Column) -> Column:
    """Only digits, superscripts and subscripts included."""
    return token.rlike(DIGITS_PATTERN)


def split_lemma(lemma: Column) -> Column:
    """Punctuation and Unicode spaces inside a lemma separate parts; empty ones are dropped."""
    gaps = LEMMA_PUNCTUATION + UNICODE_SPACES
    spaced = F.translate(lemma, gaps, " " * len(gaps))
    return F.filter(F.split(spaced, " "), lambda part: part != "")


def symbol_for(lemma: Column) -> Column:
    """`%`, `$` or `€` for the lemmas that name them, else NULL."""
    symbol = F.lit(None).cast("string")
    for sign, lemmas in SYMBOL_LEMMAS.items():
        symbol = F.when(lemma.isin(lemmas), sign).otherwise(symbol)
    return symbol


def negation_for(form: Column) -> Column:
    """`ne` for an elided negation, else NULL."""
    return F.when(form.isin(NEGATIONS), "ne")


def is_stop_lemma(lemma: Column) -> Column:
    return lemma.isin(STOP_LEMMAS)


def is_excluded_pos(pos: Column) -> Column:
    return pos.isin(EXCLUDED_POS)


def normal_parts(form: Column, lemma: Column) -> Column:
    """Normalised lemma as an array of words, before lengths are looked at."""
    sign = F.coalesce(symbol_for(lemma), negation_for(form))
    return F.when(sign.isNotNull(), F.array(sign)).otherwise(split_lemma(lemma))


def finish_parts(parts: Column) -> Column:
    """Drop one-character parts, then lower-case and strip; parts left empty are dropped."""
    long_enough = F.filter(parts, lambda part: F.length(part) > 1)
    stripped = F.transform(long_enough, lambda part: strip_chars(F.lower(part)))
    return F.filter(stripped, lambda part: part != "")


def lexical_tokens(annotated: Column) -> Column:
    """Tokens of an array of (form, lemma, pos) structs.

    Excluded parts of speech and stop lemmas go first; what is left is either a number,
    kept whole, or a lemma, normalised and split.
    """
    kept = F.filter(
        annotated,
        lambda t: ~is_excluded_pos(t["pos"]) & ~is_stop_lemma(t["lemma"]),
    )

    def words(t: Column) -> Column:
        bare = strip_chars(t["form"])
        return F.when(is_number(bare), F.array(bare)).otherwise(
            finish_parts(normal_parts(t["form"], t["lemma"]))
        )

    return F.flatten(F.transform(kept, words))


def merge_party_name(tokens: Column) -> Column:
    """`open` followed by `vld` becomes one token; a trailing `open` is left alone."""

    def merged(token: Column, i: Column) -> Column:
        here = F.lower(token)
        before = F.lower(F.get(tokens, i - 1))
        after = F.lower(F.get(tokens, i + 1))
        return (
            F.when((here == "open") & F.coalesce(after == "vld", F.lit(False)), PARTY_NAME)
            .when((here == "vld") & F.coalesce(before == "open", F.lit(False)), None)
            .otherwise(token)
        )

    return F.filter(F.transform(tokens, merged), lambda t: t.isNotNull())


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def lower_words(words: Column) -> Column:
    return F.transform(words, F.lower)


def display_text(text: Column, score: Column) -> Column:
    """Document text and its score to two places, as shown side by side when judging."""
    shown = F.round(score, 2).cast("string")
    return F.concat(F.lit("TEXT : \n"), text, F.lit("\n\n SCORE : \n"), shown)


def display_date(date: Column) -> Column:
    return F.date_format(date, "dd-MM-yy")


def display_score(score: Column) -> Column:
    return F.format_string("%8.2f", score)
