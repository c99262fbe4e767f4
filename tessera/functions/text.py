"""Text representations of names, addresses, countries and identifiers as column expressions.

Stage order: NFKC, control strip, case fold, white space, punctuation policy, white space.
Only the Unicode forms need Python: ASCII rows pass it as nulls, so it works on the others'
text alone.  Case folding is a JVM expression.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Typographic characters and the plain ones they fold to.
FOLDS = {
    "\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'", "\u201c": '"', "\u201d": '"', "\u201e": '"', "\u201f": '"',
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "-", "\u2015": "-", "\u2212": "-",
    "\u00ad": "", "\u00a0": " ", "\u2007": " ", "\u2009": " ", "\u200a": " ", "\u202f": " ", "\u3000": " ", "\u2003": " ", "\u2026": "...",
}
#: Punctuation that stays; all other punctuation and symbols become spaces.
KEPT_PUNCTUATION = "&'-.#,/"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{feff}]"
STAGES = ("unicode", "control", "folded", "spaced", "cleaned")


# Worker functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["tessera.functions"])


FORMS = ("NFC", "NFD", "NFKC", "NFKD")


def unicode_form(x, form: str = "NFKC") -> Column:
    """A Unicode normal form.  Spark evaluates Python on every row whatever a CASE around it
    says, so ASCII rows, which no form changes, are sent as nulls."""
    if form not in FORMS:
        raise ValueError(f"unknown Unicode form {form}")
    x = _column(x)

    def run(s: pd.Series) -> pd.Series:
        return s.str.normalize(form)

    return F.when(is_ascii(x), x).otherwise(F.pandas_udf(run, "string")(F.when(~is_ascii(x), x)))


def _column(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_ascii(x) -> Column:
    return _column(x).rlike(r"\A[\x00-\x7f]*\z")


def present(x) -> Column:
    """Null for a missing value: null or the empty string."""
    return F.nullif(_column(x), F.lit(""))


def strip_control(x) -> Column:
    return F.regexp_replace(_column(x), CONTROL, "")


def collapse_whitespace(x) -> Column:
    return F.trim(F.regexp_replace(_column(x), r"(?U)\s+", " "))


def fold_punctuation(x) -> Column:
    single = {k: v for k, v in FOLDS.items() if len(v) == 1} | {k: v for k, v in FOLDS.items() if not v}
    out = F.translate(_column(x), "".join(single), "".join(single.values()))
    for k, v in FOLDS.items():
        if len(v) > 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return out


def punctuation_policy(x) -> Column:
    """Fold typographic marks, keep the listed ones, turn other punctuation and symbols into
    spaces, and drop what is neither letter, number, mark nor space."""
    kept = KEPT_PUNCTUATION.replace("-", r"\-").replace("#", r"\#")
    out = F.regexp_replace(fold_punctuation(x), rf"[\p{{P}}\p{{S}}&&[^{kept.replace('&', chr(92) + '&')}]]", " ")
    out = F.regexp_replace(out, r"(?U)[\s\p{Zs}]", " ")
    return F.regexp_replace(out, rf"[^\p{{L}}\p{{N}}\p{{M}} {kept.replace('&', chr(92) + '&')}]", "")


# Letters that fold to more than one.
SPELLED_OUT = {"\u00df": "ss", "\u1e9e": "ss", "\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st", "\ufb06": "st", "\u0149": "\u02bcn", "\u01f0": "j\u030c", "\u0587": "\u0565\u0582"}
#: Letters whose folded form is another letter than their lower case (both final and long s,
#: old forms of Greek letters, ...), by Unicode's own rule.
_LETTERS = [c for c in map(chr, range(128, 0x20000)) if len(c.casefold()) == 1 and c.casefold() != c.lower() and not 0x13A0 <= ord(c) <= 0x13FF and not 0xAB70 <= ord(c) <= 0xABBF]
FOLD_FROM, FOLD_TO = "".join(_LETTERS), "".join(c.casefold() for c in _LETTERS)


def casefold(x) -> Column:
    """Full case folding in the JVM; only Greek letters with an iota below, or with several
    accents and no capital of their own, keep them."""
    x = _column(x)
    full = x
    for letter, spelled in SPELLED_OUT.items():
        full = F.replace(full, F.lit(letter), F.lit(spelled))
    full = F.translate(F.lower(full), FOLD_FROM, FOLD_TO)
    return F.when(is_ascii(x), F.lower(x)).otherwise(full)


def stages(x, ascii_only: bool = False, form: str = "NFKC") -> dict[str, Column]:
    """The five representations of a value; a missing value has none."""
    raw = present(x)
    unicode = raw if ascii_only else unicode_form(raw, form)
    control = strip_control(unicode)
    folded = F.lower(control) if ascii_only else casefold(control)
    spaced = collapse_whitespace(folded)
    return dict(zip(STAGES, (unicode, control, folded, spaced, collapse_whitespace(punctuation_policy(spaced)))))


def changed_at(x, stage: str, ascii_only: bool = False) -> Column:
    """Has a stage changed what the stage before it gave?"""
    held = {"raw": present(x), **stages(x, ascii_only)}
    names = list(held)
    if stage not in names:
        raise KeyError(f"unknown stage {stage}")
    at = names.index(stage)
    return F.lit(False) if at == 0 else F.coalesce(held[stage] != held[names[at - 1]], F.lit(False))


def cleaned(x, ascii_only: bool = False) -> Column:
    return stages(x, ascii_only)["cleaned"]


def alnum_tokens(x) -> Column:
    return F.regexp_extract_all(_column(x), F.lit(r"([\p{L}\p{N}]+)"), 1)


def word_tokens(x) -> Column:
    """Letters, numbers and underscores."""
    return F.regexp_extract_all(_column(x), F.lit(r"([\p{L}\p{N}_]+)"), 1)


def whitespace_tokens(x) -> Column:
    return F.filter(F.split(_column(x), r"(?U)\s+"), lambda t: t != "")


def normalized_tokens(x, drop: tuple = (), min_length: int = 1, sort: bool = False) -> Column:
    out = F.filter(alnum_tokens(x), lambda t: (F.length(t) >= min_length) & ~t.isin(*drop) if drop else F.length(t) >= min_length)
    return F.array_sort(out) if sort else out


def compact(x) -> Column:
    return F.array_join(alnum_tokens(x), "")


def char_ngrams(x, n: int) -> Column:
    """Runs of n characters in order; a shorter, non-empty text is its own only gram."""
    x = _column(x)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - n + 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(n)))
    return F.when(F.length(x) == 0, F.array().cast("array<string>")).otherwise(grams)


def word_ngrams(tokens: Column, n: int) -> Column:
    return F.when(F.size(tokens) < n, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(tokens) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))
    )


def common_prefix(a, b) -> Column:
    """Length of the longest common beginning."""
    a, b = _column(a), _column(b)
    n = F.least(F.length(a), F.length(b))
    same = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))
    return F.when(n == 0, F.lit(0)).otherwise(F.size(F.filter(same, lambda s: s)))


def map_tokens(tokens: Column, table: dict[str, str]) -> Column:
    """Rewrite whole tokens; a token mapped to the empty string goes."""
    if not table:
        return tokens
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.filter(F.transform(tokens, lambda t: F.coalesce(known[t], t)), lambda t: t != "")


def name_representations(x, abbreviations: dict | None = None, suffixes: dict | None = None, ascii_only: bool = False) -> dict[str, Column]:
    """name, name_core (without legal suffixes), name_sorted and name_tokens."""
    spelled = F.replace(cleaned(x, ascii_only), F.lit("&"), F.lit(" and "))
    tokens = map_tokens(map_tokens(alnum_tokens(spelled), abbreviations or {}), suffixes or {})
    legal = set(suffixes or {}) | set((suffixes or {}).values())
    core = F.filter(tokens, lambda t: ~t.isin(*sorted(legal))) if legal else tokens
    return {"name": F.array_join(tokens, " "), "name_core": F.array_join(core, " "), "name_sorted": F.array_join(F.array_sort(tokens), " "), "name_tokens": tokens}


def address_representations(x, tables: tuple[dict, ...] = (), ascii_only: bool = False) -> dict[str, Column]:
    """Comma components with rewritten tokens, and the numbers that identify a place."""

    def rewrite(component: Column) -> Column:
        tokens = F.filter(F.split(F.trim(component), " +"), lambda t: t != "")
        for table in tables:
            tokens = map_tokens(tokens, table)
        return F.array_join(tokens, " ")

    parts = F.filter(F.transform(F.split(cleaned(x, ascii_only), ","), rewrite), lambda c: c != "")
    numbers = F.flatten(F.transform(parts, lambda c: F.regexp_extract_all(c, F.lit("([0-9]+)"), 1)))
    numbered = F.filter(parts, lambda c: c.rlike("[0-9]"))
    postal = F.filter(F.transform(parts, lambda c: F.replace(F.replace(c, F.lit(" ")), F.lit("-"))), lambda c: c.rlike("^([0-9]{5}|[0-9]{6}|[0-9]{9})$"))
    return {
        "address": F.array_join(parts, ", "),
        "address_sorted": F.array_join(F.array_sort(parts), ", "),
        "address_components": parts,
        "address_numbers": numbers,
        "address_house_number": F.when(F.size(numbered) > 0, F.regexp_extract(F.get(numbered, F.lit(0)), "([0-9]+)", 1)),
        "address_postal": F.when(F.size(postal) > 0, F.element_at(postal, -1)),
        "address_unit": present(F.regexp_extract(F.array_join(parts, ", "), UNIT, 1)),
    }


UNIT = r"\b(?:apt|apartment|unit|suite|ste|floor|fl|room|rm)\.? ?([\p{L}\p{N}-]+)"


def country_representations(x, ascii_only: bool = False) -> dict[str, Column]:
    c = cleaned(x, ascii_only)
    return {"country": c, "country_token": F.replace(c, F.lit(" "), F.lit("_"))}


def identifier_representations(x) -> dict[str, Column]:
    x = F.trim(_column(x))
    last = F.element_at(F.split(x, "-"), -1)
    return {"id_prefix": F.when(F.contains(x, F.lit("-")), F.split_part(x, F.lit("-"), F.lit(1))), "id_body": present(F.regexp_replace(last, "[^0-9]", ""))}


KINDS = ("country", "address", "name", "identifier", "generic")
# Representations of every column and those of each kind, in order.
TOKENS = ("tokens", "char_ngrams", "token_count")
OF_KIND = {
    "name": ("name", "name_core", "name_sorted"), "address": ("address", "address_sorted", "address_numbers", "address_house_number", "address_postal", "address_unit"),
    "country": ("country", "country_token"), "identifier": ("id_prefix", "id_body"), "generic": (),
}


def plan(columns: list[str]) -> dict[str, tuple[str, ...]]:
    """The representation columns that each column of a table gets, by the kind of its name."""
    return {c: ("raw", *STAGES, *TOKENS, *OF_KIND[classify_column(c)]) for c in columns}


def representations(df: DataFrame, columns: list[str] | None = None, rules: dict | None = None) -> DataFrame:
    """The table with all its columns as they are and a column ``<column>__<name>`` for each
    planned representation.  ``rules``: abbreviations, suffixes and address tables."""
    rules, planned = rules or {}, plan(columns or df.columns)
    text = lambda c: F.col(c).cast("string")
    # The stages first: Python may not stand inside the functions below.
    df = df.withColumns({f"{c}__{n}": v for c in planned for n, v in {"raw": text(c), **stages(text(c))}.items()})
    out: dict[str, Column] = {}
    for c, names in planned.items():
        tokens = alnum_tokens(f"{c}__cleaned")
        held = {"tokens": tokens, "char_ngrams": char_ngrams(F.array_join(tokens, ""), 3), "token_count": F.size(tokens)}
        kind = classify_column(c)
        if kind == "name":
            held |= name_representations(text(c), rules.get("abbreviations"), rules.get("suffixes"))
        elif kind == "address":
            held |= address_representations(text(c), tuple(rules.get("address", ())))
        elif kind == "country":
            held |= country_representations(text(c))
        elif kind == "identifier":
            held |= identifier_representations(text(c))
        out |= {f"{c}__{n}": held[n] for n in names if n in held}
    return df.withColumns(out)


def classify_column(name: str) -> str:
    """The kind of a column by its name: country, address, name, identifier or generic."""
    n = name.lower()
    if n == "country" or n.endswith("_country"):
        return "country"
    if "address" in n:
        return "address"
    if "name" in n:
        return "name"
    return "identifier" if n == "id" or n.endswith("_id") else "generic"


# ---- the small alternative normalizers ----

# Tables of the alternative normalizers.
LEGAL_SUFFIXES = {
    "llc": "LLC", "inc": "Inc", "corp": "Corp", "ltd": "Ltd", "llp": "LLP", "lp": "LP", "pc": "PC", "pllc": "PLLC", "private limited": "Private Limited", "pvt ltd": "Pvt Ltd", "pvt. ltd": "Pvt Ltd",
    "pvt ltd.": "Pvt Ltd", "co": "Co", "company": "Company", "corporation": "Corporation", "incorporated": "Incorporated", "limited": "Limited",
}
NAME_ABBREVIATIONS = {
    "&": "and", "w/": "with", "w/o": "without", "vs": "versus", "dept": "department", "div": "division", "intl": "international", "mfg": "manufacturing", "svcs": "services", "solns": "solutions",
    "tech": "technology", "mgmt": "management", "admin": "administration", "assoc": "associates", "grp": "group", "hdqtrs": "headquarters", "hq": "headquarters",
}
STREETS = {
    "st": "Street", "street": "Street", "ave": "Avenue", "avenue": "Avenue", "rd": "Road", "road": "Road", "blvd": "Boulevard", "boulevard": "Boulevard", "dr": "Drive", "drive": "Drive", "ln": "Lane",
    "lane": "Lane", "ct": "Court", "court": "Court", "pl": "Place", "place": "Place", "pkwy": "Parkway", "parkway": "Parkway", "cir": "Circle", "circle": "Circle", "tr": "Trail", "trail": "Trail",
    "way": "Way", "hwy": "Highway", "highway": "Highway",
}
UNITS = {"apt": "Apt", "apartment": "Apt", "suite": "Suite", "ste": "Suite", "unit": "Unit", "floor": "Floor", "fl": "Floor", "bldg": "Building", "building": "Building", "room": "Room", "rm": "Room", "#": "Unit"}
DIRECTIONS = {
    "n": "N", "s": "S", "e": "E", "w": "W", "ne": "NE", "nw": "NW", "se": "SE", "sw": "SW", "north": "N", "south": "S", "east": "E", "west": "W", "northeast": "NE", "northwest": "NW",
    "southeast": "SE", "southwest": "SW",
}
COUNTRIES = {"usa": "US", "us": "US", "u.s.": "US", "u.s.a.": "US", "united states": "US", "united states of america": "US", "india": "India", "france": "France"}


def _one_space(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, " +", " "))


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in text)


def replace_words(x: Column, table: dict[str, str], dotted: bool = True, spaced: bool = True) -> Column:
    """Whole words (longest first, any case, with an optional full stop) to their forms."""
    for word in sorted(table, key=len, reverse=True):
        edge = (r"\b", r"\.?\b" if dotted else r"\b") if dotted or word.isalnum() else (r"(?<!\w)", r"(?!\w)")
        x = F.regexp_replace(x, f"(?i){edge[0]}{_quoted(word)}{edge[1]}", f" {table[word]} " if spaced else table[word])
    return _one_space(x) if spaced else x


def alternative_name(x) -> Column:
    out = F.regexp_replace(_column(x), r"\s*&\s*", " and ")
    out = replace_words(replace_words(out, LEGAL_SUFFIXES), NAME_ABBREVIATIONS, dotted=False, spaced=False)
    return _one_space(F.regexp_replace(F.regexp_replace(out, r"\s*,\s*", ", "), r"\s*\.\s*", ". "))


def alternative_address(x) -> Column:
    out = F.regexp_replace(F.regexp_replace(_column(x), r"\s*,\s*", ", "), r"\s*;\s*", ", ")
    out = _one_space(F.regexp_replace(out, r"\s*\.\s*", " "))
    out = replace_words(replace_words(out, STREETS), UNITS)
    out = _one_space(F.regexp_replace(out, r"#\s*(\d+)", "Unit $1"))
    return replace_words(out, DIRECTIONS)


def alternative_fields(country, city, postal, phone, email) -> dict[str, Column]:
    known = F.create_map(*[F.lit(x) for pair in COUNTRIES.items() for x in pair])
    trimmed = F.trim(_column(country))
    return {
        "country": F.coalesce(known[F.lower(trimmed)], trimmed),
        "city": F.initcap(F.trim(_column(city))),
        "postal_code": F.upper(F.regexp_replace(_column(postal), "[ -]", "")),
        "phone": F.regexp_replace(_column(phone), "[^0-9]", ""),
        "email": F.lower(F.trim(_column(email))),
    }
