"""Key normalisers as column expressions; each rule is its own, as joins depend on it."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Three-letter language codes (both kinds) and their two-letter codes.
THREE_LETTERS = {
    "bul": "bg", "chi": "zh", "deu": "de", "dut": "nl", "ell": "el", "eng": "en", "fra": "fr", "fre": "fr", "ger": "de", "gre": "el",
    "ita": "it", "jpn": "ja", "nld": "nl", "por": "pt", "spa": "es", "tha": "th", "zho": "zh",
}

# Cyrillic letters (Bulgarian) and their Latin spelling.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o",
    "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ь": "", "ю": "iu", "я": "ia",
}

# German letters spelt out.
GERMAN = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"}

# Leading articles of French, Italian, Spanish and Catalan names.
ARTICLES = r"^(?:l['’]\s*|(?:le|la|les|el|els|los|las|il|lo|gli|i|un|une)\s+)"

# Words and single letters that only tell a colour.
COLOURS = ("blanc", "blanche", "bianco", "bianca", "blanco", "blanca", "branco", "branca", "weiss", "noir", "noire", "nero", "nera", "negro", "preto", "rouge", "rosso", "rossa", "tinto", "rot", "gris", "grigio", "rose", "rosa", "rosado")


@functools.lru_cache(2)
def _accents(form: str) -> tuple[str, str]:
    """Characters that a base letter and marks make up, and their base letters: by Unicode's decompositions up to U+2000."""
    pairs = []
    for cp in range(0x80, 0x2000):
        bare = "".join(c for c in unicodedata.normalize(form, chr(cp)) if not unicodedata.combining(c))
        if len(bare) == 1 and bare != chr(cp) and bare.isalpha():
            pairs.append((chr(cp), bare))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def unaccent(c: Column, form: str = "NFD") -> Column:
    """Base letters of accented letters of all scripts, in the JVM; marks that stand alone are dropped."""
    return F.translate(F.regexp_replace(c, "[\u0300-\u036f]", ""), *_accents(form))


def ascii_only(c: Column) -> Column:
    """Base letters, forms that are only compatible included, and what has no ASCII form left out."""
    return F.regexp_replace(unaccent(c, "NFKD"), r"[^\x00-\x7F]", "")


def slugify(c: Column) -> Column:
    """Lower-case ASCII words joined by hyphens."""
    return F.trim(F.regexp_replace(F.lower(ascii_only(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def squeeze(c: Column) -> Column:
    """Lower-case letters and digits only, for joins that ignore spacing and marks."""
    return F.regexp_replace(F.lower(ascii_only(c)), "[^a-z0-9]", "")


def without_article(c: Column) -> Column:
    """The key without a parenthesis and a leading article."""
    bare = F.trim(F.regexp_replace(F.lower(c), r"\([^)]*\)", ""))
    return squeeze(F.regexp_replace(bare, ARTICLES, ""))


def place_key(c: Column) -> Column:
    """Apostrophes and hyphens are blanks first, then a leading article goes, then all but letters and digits."""
    spaced = F.trim(F.regexp_replace(F.lower(unaccent(c)), r"['’‘`´-]+", " "))
    return squeeze(F.regexp_replace(spaced, r"^(?:l|d|le|la|les|du|de|des|aux|au|en)\s+", ""))


def inverted_article(c: Column) -> Column:
    """A name whose article follows a comma (``Molar, el``) in reading order, without it; of two forms with a slash the first."""
    first = F.trim(F.element_at(F.split(F.lower(unaccent(c)), "/"), 1))
    bare = F.regexp_replace(first, r"\s*,\s*(?:el|la|los|las|els|les|l['’]|o|a|os|as)\s*$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, ARTICLES, ""), r"[^a-z0-9]+", " "))


def transliterated(c: Column) -> Column:
    """Cyrillic letters in Latin spelling, no marks, punctuation as blanks, lower case."""
    out = F.lower(c)
    single = {k: v for k, v in CYRILLIC.items() if len(v) == 1}
    out = F.translate(out, "".join(single) + "ъь", "".join(single.values()))
    for letter, spelt in CYRILLIC.items():
        if len(spelt) > 1:
            out = F.replace(out, F.lit(letter), F.lit(spelt))
    return F.trim(F.regexp_replace(unaccent(out), r"(?U)[^\p{L}\p{N}]+", " "))


def upper_key(c: Column) -> Column:
    """Capitals without marks, blanks collapsed."""
    return F.trim(F.regexp_replace(F.upper(unaccent(c)), r"\s+", " "))


def cyrillic_key(c: Column, prefixes: Iterable[str] = ("гр", "с", "община", "област")) -> Column:
    """Cyrillic kept, lower case, without a leading word for the kind of place."""
    kinds = "|".join(prefixes)
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.lower(c)), rf"^(?:{kinds})\.?\s+", ""), r"(?U)[^\p{L}\p{N}]+", " "))


def greek_key(c: Column) -> Column:
    """Greek without accents and final sigma, lower case; endings of case and gender cut off words of five letters or more."""
    bare = F.replace(F.lower(unaccent(c)), F.lit("ς"), F.lit("σ"))
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?U)[^\p{L}\p{N}]+", " "), r"(?U)(?<=\p{L}{3})(?:ουσ|ων|οσ|ου|ασ|ησ|εσ|οι|α|η|ο|ι)(?= |$)", ""))


def german_key(c: Column) -> Column:
    """Umlauts and sharp s spelt out, Saint as one word, letters and digits only."""
    out = F.lower(c)
    for letter, spelt in GERMAN.items():
        out = F.replace(out, F.lit(letter), F.lit(spelt))
    return squeeze(F.regexp_replace(out, r"\b(?:st\.|sankt\b)\s*", "sankt"))


def search_key(c: Column) -> Column:
    return F.lower(unaccent(c))


def variety_key(c: Column) -> Column:
    """Words without marks, colour words and single letters, joined by blanks."""
    words = F.split(F.trim(F.regexp_replace(search_key(c), r"(?U)[^\p{L}\p{N}]+", " ")), " ")
    return F.array_join(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*COLOURS)), " ")


def none_if_blank(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def title_case(c: Column) -> Column:
    """Capital after a blank, hyphen, apostrophe or bracket; the rest small."""
    parts = F.split(F.lower(c), "")
    start = F.array(*[F.lit(x) for x in (" ", "-", "'", "(")])
    return F.array_join(F.transform(parts, lambda x, i: F.when((i == 0) | F.array_contains(start, F.coalesce(F.get(parts, i - 1), F.lit(" "))), F.upper(x)).otherwise(x)), "")


def content_key(*columns: Column) -> Column:
    """SHA-256 of the columns joined by a zero character."""
    return F.sha2(F.concat_ws("\0", *columns), 256)


def request_key(system: Column, user: Column) -> Column:
    """The first 32 hexadecimal digits of the content key of a request."""
    return F.substring(content_key(system, user), 1, 32)


def number_list(c: Column) -> Column:
    """Numbers of a list with ranges, e.g. ``1, 4 y del 7 al 9``, ascending and distinct; other words end the part they stand in."""
    text = F.regexp_replace(F.lower(c), r"(?<=\d)\s*(?:al|a|hasta el|hasta|bis|-|–)\s*(?=\d)", "~")
    parts = F.split(F.regexp_replace(text, r"\b(?:del|de|desde|el|los|n\.?º?)\s+(?=\d)", ""), r"\s*(?:[,;]|\b(?:y|e|i|et|und)\b)\s*")
    numbers = F.transform(F.filter(parts, lambda x: x.rlike(r"^\s*\d{1,9}(~\d{1,9})?\s*$")), lambda x: F.transform(F.split(F.trim(x), "~"), lambda y: y.cast("int")))
    spans = F.transform(numbers, lambda x: F.when(F.element_at(x, -1) >= x[0], F.sequence(x[0], F.element_at(x, -1))).otherwise(F.array(x[0])))
    return F.array_sort(F.array_distinct(F.flatten(spans)))


def outside_brackets(c: Column) -> Column:
    """Parts between commas that stand in no bracket."""
    masked = F.regexp_replace(c, r",(?=[^()]*\))", "\u0001")
    return F.transform(F.split(masked, r"\s*,\s*"), lambda x: F.trim(F.regexp_replace(x, "\u0001", ",")))


def place_list(c: Column) -> Column:
    """Names between commas, semicolons or ``et`` outside brackets; a word broken at a line's end is joined, other line ends are blanks."""
    flat = F.regexp_replace(F.regexp_replace(c, r"(?U)(?<=\p{Ll})-\s*\n\s*(?=\p{Ll})", ""), r"\s+", " ")
    masked = F.regexp_replace(flat, r"(?:[,;]| et )(?=[^()]*\))", "\u0001")
    parts = F.transform(F.split(masked, r"\s*[,;]\s*| et "), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "\u0001", ","), r"[\s.]+$", "")))
    return F.filter(parts, lambda x: x != "")


def natural_key(c: Column) -> Column:
    """Dotted numbers as arrays of integers, which sort as numbers."""
    return F.transform(F.split(c, r"\."), lambda x: x.try_cast("int"))


def language_code(label: Column) -> Column:
    """Two-letter lower-case code of a label however spelt; null for null, empty, ``und`` and what is no code."""
    head = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]{2,3})(?:$|[-_])", 1))
    table = F.create_map(*[F.lit(x) for kv in THREE_LETTERS.items() for x in kv])
    return F.when(F.length(head) == 2, head).when(F.length(head) == 3, F.try_element_at(table, head))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading characters two texts share."""
    most = F.least(F.length(a), F.length(b))
    return F.when(most < 1, F.lit(0)).otherwise(F.size(F.filter(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))))


def without_prefix(name: Column, *owners: Column) -> Column:
    """A name without the first of the owners' names it begins with, and without what joins them; the whole name where nothing would be left."""
    out = name
    for owner in reversed(owners):
        rest = F.regexp_replace(F.substring(name, F.length(owner) + 1, F.length(name)), r"^[\s\-–,:]+(?:(?:de|du|des|d['’])\s*)?", "")
        out = F.when((F.length(owner) > 0) & F.startswith(F.lower(name), F.lower(owner)) & (rest != ""), rest).otherwise(out)
    return out


def joined_set(values: Column) -> Column:
    """``;a;b;`` of an array, so that a value is found by ``;value;``; empty for none."""
    got = F.array_compact(F.coalesce(values, F.array().cast("array<string>")))
    return F.when(F.size(got) > 0, F.concat(F.lit(";"), F.array_join(got, ";"), F.lit(";"))).otherwise("")


def clamped(c: Column, most: int = 160) -> Column:
    """Blanks collapsed; longer texts cut at the last whole word, with an ellipsis, to ``most`` characters in all."""
    flat = F.trim(F.regexp_replace(c, r"\s+", " "))
    head = F.substring(flat, 1, most - 1)
    whole = F.when(F.substring(flat, most, 1) == " ", head).otherwise(F.regexp_replace(head, r"\s+\S*$", ""))
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.regexp_replace(whole, r"[\s,;:.]+$", ""), F.lit("…")))


def filled(template: str, **values: Column) -> Column:
    """A template with ``{name}`` for each value; null values and unknown names give nothing."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return F.regexp_replace(out, r"\{\w+\}", "")


# The months in French.
MONTHS = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")


def french_date(c: Column) -> Column:
    """The first date written out in French (``3 août 2011``, ``1er mai 1999``); null where there is none or no such day."""
    pattern = rf"(?iu)\b(\d{{1,2}})(?:er)?\s+({'|'.join(MONTHS)})\s+(\d{{4}})\b"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(c, pattern, 2)))
    return F.try_to_date(F.when(month > 0, F.concat_ws("-", F.regexp_extract(c, pattern, 3), month.cast("string"), F.regexp_extract(c, pattern, 1))), "yyyy-M-d")


def qid(c: Column) -> Column:
    """The item number (``Q`` and digits) of a link or label; empty where there is none."""
    return F.upper(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?i)(?:^|/)(q[1-9]\d*)(?:$|[?#])", 1))
