"""Text standardisation as native Column expressions (no Python in the data path)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Organisation-name words and their standard short forms.
NAME_WORDS = {
    "INCORPORATED": "INC", "INCORP": "INC", "CORPORATION": "CORP", "COMPANY": "CO",
    "FOUNDATION": "FDN", "FOUND": "FDN", "ASSOCIATION": "ASSN", "ASSOC": "ASSN",
    "CHARITABLE": "CHAR", "UNIVERSITY": "UNIV", "COLLEGE": "COLL", "NATIONAL": "NATL",
    "INTERNATIONAL": "INTL", "LIMITED": "LTD", "SOCIETY": "SOC", "CENTER": "CTR", "CENTRE": "CTR",
    "DEPARTMENT": "DEPT", "TRUST": "TR", "AND": "&",
}
# Legal-form words removed from a name.
NAME_SUFFIXES = ["INC", "LLC", "CORP", "LTD", "CO"]
# City words and their standard short forms.
CITY_WORDS = {"SAINT": "ST", "FORT": "FT", "MOUNT": "MT"}

# Word characters are letters, digits and underscore in any script; the C0
# separators count as white space, which Java's class leaves out.
SPACE = r"[\s\x1c-\x1f]"
_NOT_WORD = r"(?U)[^\p{L}\p{N}_]+"
_EDGE_SPACE = rf"(?U)^{SPACE}+|{SPACE}+$"


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` removes only blanks)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def upper_strip(c: Column) -> Column:
    return strip(F.upper(c))


def _words(c: Column) -> Column:
    """Upper-case words of ``c``: anything that is not a word character separates."""
    return F.split(F.trim(F.regexp_replace(F.upper(c), _NOT_WORD, " ")), " ")


def _translate_words(words: Column, table: dict[str, str]) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(lookup, w), w))


def clean_name(c: Column) -> Column:
    """Standard form of an organisation name; null becomes ''.

    One pass over the words equals a chain of whole-word substitutions because
    no replacement produces a word another rule rewrites before the last step.
    """
    short = _translate_words(_words(c), NAME_WORDS)
    kept = F.filter(short, lambda w: ~w.isin(NAME_SUFFIXES))
    return F.coalesce(F.array_join(kept, " "), F.lit(""))


def clean_city(c: Column) -> Column:
    """Standard form of a city name; null becomes ''."""
    return F.coalesce(F.array_join(_translate_words(_words(c), CITY_WORDS), " "), F.lit(""))


def clean_state(c: Column) -> Column:
    """First two characters, upper case; null becomes ''."""
    return F.coalesce(F.substring(upper_strip(c), 1, 2), F.lit(""))


def clean_zip(c: Column) -> Column:
    """First run of five digits, '' when there is none."""
    return F.coalesce(F.regexp_extract(c, r"(\d{5})", 1), F.lit(""))


def zip5(c: Column) -> Column:
    """First five characters, left-padded with zeros; null stays null."""
    return F.lpad(F.substring(c, 1, 5), 5, "0")


def lookup_key(name: Column, city: Column) -> Column:
    return F.concat_ws("|", name, city)


def sorted_tokens(c: Column) -> Column:
    """Words of ``c`` in code-point order, joined by one blank."""
    return F.array_join(F.array_sort(F.filter(F.split(c, rf"(?U){SPACE}+"), lambda w: w != "")), " ")


def digits_of(c: Column) -> Column:
    """First run of digits (the index inside a numbered column name)."""
    return F.regexp_extract(c, r"(\d+)", 1)


def stem_token(path: Column) -> Column:
    """File stem up to its first underscore: ``a/b/123_public.xml`` -> ``123``."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.split(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), "_")[0]


def url_file_name(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), r"([^/]*)$", 1)


def megabytes(n_bytes: Column) -> Column:
    return F.round(n_bytes / F.lit(1024 * 1024), 2)


def na_to_null(c: Column) -> Column:
    """Null for the tokens a CSV reader treats as missing."""
    from almsflow.schemas import NA_TOKENS

    return F.when(~c.isin(NA_TOKENS), c)
