"""Text, identifier, date and catalogue-string functions as Column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, which results depend on: marks that a token loses, abbreviations, and quotes in the
# order in which they are replaced.
PUNCTUATION = ',.?!$%&():;-"'
ABBREVIATIONS = ("dr.", "est.", "i.e.", "jr.", "inc.", "ltd.", "mr.", "mrs.", "ms.", "oz.", "sr.", "vs.", "e.g.")
QUOTES = ("“", "”", "''", "‘‘", "’’")


def clean_quotes(s: Column) -> Column:
    """Every quote variant becomes a plain double quote; doubled apostrophes after curly ones."""
    for q in QUOTES:
        s = F.replace(s, F.lit(q), F.lit('"'))
    return s


def depunctuate(s: Column, marks: str = PUNCTUATION) -> Column:
    return F.translate(s, marks, "")


def is_number(s: Column) -> Column:
    return depunctuate(s).rlike(r"^\p{Nd}+$")


def is_initial(s: Column) -> Column:
    return s.rlike(r"^\p{Lu}\.$")


def is_abbreviation(s: Column) -> Column:
    return F.lower(s).isin(*ABBREVIATIONS)


def isnt_capital(s: Column) -> Column:
    """All cased characters are small and there is one, or a run of ASCII punctuation in the order of
    its code points (also the empty text)."""
    return (s.rlike(r"\p{Ll}") & ~s.rlike(r"[\p{Lu}\p{Lt}]")) | F.contains(F.lit(string.punctuation), s)


def all_capitals(s: Column) -> Column:
    """No character but capitals; true for the empty text."""
    return s.rlike(r"^\p{Lu}*$")


def char_is(s: Column, i: Column, kind: str) -> Column:
    """Whether the character at index i (from 0) is ``alpha`` or ``digit``; true outside."""
    c = F.when((i >= 0) & (i < F.length(s)), F.substring(s, i + 1, F.lit(1)))
    return F.coalesce(c.rlike(r"^\p{L}$" if kind == "alpha" else r"^\p{Nd}$"), F.lit(True))


def dictionary_key(s: Column) -> Column:
    """What a token is looked up by."""
    return depunctuate(F.lower(s))


def words(s: Column) -> Column:
    """Blank-separated tokens without empty ones."""
    return F.filter(F.split(s, r"\s+"), lambda w: w != "")


def split_keeping(s: Column, delimiters: str = r" /\-\"'") -> Column:
    """Tokens and delimiters in order; joined with nothing they give the text again."""
    return F.regexp_extract_all(s, F.lit(rf"[{delimiters}]|[^{delimiters}]+"), F.lit(0))


def clean_name(s: Column) -> Column:
    """Characters that file systems and shells mind become underscores."""
    return F.regexp_replace(s, r"[|@#!¡·$€%&()=?¿^*;:,¨´><+]", "_")


def words_from_code_points(s: Column) -> Column:
    """``72_105`` to ``Hi``: decimal code points joined by underscores (also beyond 255)."""
    def char(c: Column) -> Column:
        n = F.try_to_number(c, F.lit("9999999")).cast("int")
        utf16 = F.concat(F.lit("0000"), F.hex(n))
        two = F.hex(55296 + F.shiftright(n - 65536, 10)), F.hex(56320 + (n - 65536) % 1024)
        return F.decode(F.unhex(F.when(n < 65536, F.right(utf16, F.lit(4))).otherwise(F.concat(*two))), "UTF-16BE")

    return F.array_join(F.transform(F.split(s, "_"), char), "")


def path_tail(path: Column, parts: int = 4) -> Column:
    """The last path parts joined by underscores."""
    p = F.split(path, "/")
    n = F.least(F.lit(parts), F.size(p))
    return F.array_join(F.slice(p, -n, n), "_")


def pad_left(s: Column, width: int) -> Column:
    """Zero-padded to ``width``; longer values stay whole."""
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def edition_parts(edition: Column) -> Column:
    """``YYYYMMDDee``: year, month, day, edition and the date (null if there is no such day)."""
    y, m, d = F.substring(edition, 1, 4), F.substring(edition, 5, 2), F.substring(edition, 7, 2)
    return F.struct(y.alias("year"), m.alias("month"), d.alias("day"), F.substring(edition, 9, 2).alias("edition"),
                    F.try_to_date(F.concat(y, m, d), "yyyyMMdd").alias("date"))


def scan_url(base: str, lccn: Column, edition: Column, page: Column) -> Column:
    e = edition_parts(edition)
    return F.format_string(f"{base}/lccn/%s/%s-%s-%s/ed-%s/seq-%s.jp2", lccn, e["year"], e["month"], e["day"], F.regexp_replace(e["edition"], "^0+(?=.)", ""), F.regexp_replace(page, "^0+(?=.)", ""))


def dashed_date(s: Column) -> Column:
    """An eight-digit date with dashes; anything else as it is."""
    return F.when(F.length(s) == 8, F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))).otherwise(s)


def edition_id(s: Column) -> Column:
    """A date or date with edition as ``YYYY-MM-DD/ed-N``; null if it has no such form.  Ten
    characters are a date (the first edition) unless all are digits."""
    fixed = F.when((F.length(s) == 10) & s.rlike(r"^\d{10}$"), F.concat(dashed_date(F.substring(s, 1, 8)), F.lit("/ed-"), F.regexp_replace(F.substring(s, 9, 2), "^0", "")))
    fixed = F.coalesce(fixed, F.when(F.length(s).isin(8, 10), F.concat(dashed_date(s), F.lit("/ed-1"))), s)
    return F.when(fixed.rlike(r"^\d{4}-\d{2}-\d{2}/ed-\d+"), fixed)


def page_id(s: Column) -> Column:
    """A page number of at most three characters as ``seq-N``; null if it has no such form."""
    fixed = F.when(F.length(s) <= 3, F.concat(F.lit("seq-"), F.regexp_replace(s, "^0+(?=.)", ""))).otherwise(s)
    return F.when(fixed.rlike(r"^seq-\d+"), fixed)


def year_range(s: Column) -> Column:
    """``YYYY/YYYY`` with digits or question marks to (start, end) texts, else null."""
    return F.when(s.rlike(r"^[0-9?]{4}/[0-9?]{4}$"), F.struct(F.split_part(s, F.lit("/"), F.lit(1)).alias("start"), F.split_part(s, F.lit("/"), F.lit(2)).alias("end")))


def uri_tail(s: Column, from_end: int = 1) -> Column:
    """A part of a URI counted from its end, fragments and trailing slashes left out."""
    return F.try_element_at(F.split(F.regexp_replace(F.regexp_replace(s, "#.*$", ""), "/+$", ""), "/"), F.lit(-from_end))


def raw_location(iiif_url: Column) -> Column:
    """Where the raw data of an image URL lies."""
    return F.replace(F.split_part(F.regexp_extract(iiif_url, r"iiif/(?:2/)?(.*)$", 1), F.lit("/"), F.lit(1)), F.lit("%2F"), F.lit("/"))


def file_date(name: Column) -> Column:
    """Date of ``..._YYYYMMDDee_....json``, with dashes; null if the part before the last is short."""
    part = F.try_element_at(F.split(name, "_"), F.lit(-2))
    return F.when(part.rlike(r"^\d{8}"), dashed_date(F.substring(part, 1, 8)))


def title_parts(label: Column) -> Column:
    """``Name (City, State), Date`` in round or square brackets, or ``Name, City, Date``: the first
    form that fits as a whole wins."""
    forms = (r"^(.*?)\s*\(([^,()]*),?\s*([^()]*)\)\W*(.*)$", r"^(.*?)\s*\[([^,\[\]]*),?\s*([^\[\]]*)\]\W*(.*)$")
    out = None
    for form in forms:
        g = lambda i, form=form: F.btrim(F.regexp_extract(label, form, i), F.lit(" .,"))
        found = F.when(label.rlike(form), F.struct(g(1).alias("name"), g(2).alias("city"), g(3).alias("state"), g(4).alias("date")))
        out = found if out is None else F.coalesce(out, found)
    part = lambda i: F.trim(F.split_part(label, F.lit(","), F.lit(i)))
    rest = F.trim(F.regexp_extract(label, r"^[^,]*,[^,]*,(.*)$", 1))
    plain = F.when(label.rlike(r"^[^,]*,[^,]*,.*$"), F.struct(part(1).alias("name"), part(2).alias("city"), F.lit("").alias("state"), rest.alias("date")))
    return F.coalesce(out, plain)


def batch_line_path(line: Column) -> Column:
    """The edition path on a line of a batch file: without ``./`` and closing mark, and without its
    first folder unless that is a serial number."""
    path = F.regexp_replace(F.regexp_extract(line, r">\s*([^<\s]+)", 1), r"^\./", "")
    return F.when(path.startswith("sn"), path).otherwise(F.regexp_replace(path, r"^[^/]*/", ""))


def yolo_line(line: Column) -> Column:
    """``c x y w h`` to a struct; null where a number is missing."""
    p = F.split(F.trim(line), r"\s+")
    d = lambda i: F.get(p, F.lit(i)).try_cast("double")
    return F.when(F.size(p) == 5, F.struct(F.get(p, F.lit(0)).try_cast("int").alias("c"), d(1).alias("x"), d(2).alias("y"), d(3).alias("w"), d(4).alias("h")))


def flip_class(c: Column) -> Column:
    return 1 - c


def edit_share(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 for two empty texts."""
    most = F.greatest(F.length(a), F.length(b))
    return F.when(most == 0, F.lit(0.0)).otherwise(F.levenshtein(a, b) / most)


def article_key(article_id: Column) -> Column:
    """An id up to its first point."""
    return F.split_part(article_id, F.lit("."), F.lit(1))


def output_name(path: Column, url_mode: bool) -> Column:
    """File name of a scan's result."""
    if url_mode:
        return F.regexp_replace(path_tail(path, 4), r"\.[^.]*$", ".json")
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.(jpg|png|jp2|pdf)$", ".json")


def majority_normalise(word: Column, letter_of: dict[str, str], digit_of: dict[str, str]) -> Column:
    """In a mostly alphabetic word lone digits become letters, in a mostly numeric one lone letters
    become digits, by the first homoglyph of each.  Lone: both neighbours are of the other kind
    or missing."""
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    alpha = F.size(F.filter(chars, lambda c: c.rlike(r"\p{L}")))
    digit = F.size(F.filter(chars, lambda c: c.rlike(r"\p{Nd}")))
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv]) if d else F.create_map().cast("map<string,string>")

    def fix(own: str, other: str, d: dict[str, str]) -> Column:
        m = table(d)
        at = lambda i: F.coalesce(F.get(chars, i).rlike(other), F.lit(True))
        return F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(own) & at(i - 1) & at(i + 1), F.coalesce(F.try_element_at(m, c), c)).otherwise(c)), "")

    return F.when(alpha > digit, fix(r"\p{Nd}", r"\p{L}", letter_of)).when(digit > alpha, fix(r"\p{L}", r"\p{Nd}", digit_of)).otherwise(word)
