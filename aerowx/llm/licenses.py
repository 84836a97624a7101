"""Licence scans by digests of canonical whole texts.

A text is brought to a canonical form: case folded, copyright lines dropped, punctuation and
white space reduced to single spaces, and equivalent spellings made one. Its sha256 is then
looked up among the digests of known licences. All of it is built-in column functions, and
the known side is a list of licences that the caller passes, bounded by ``MAX_KNOWN``.

The whole texts known by themselves are MIT, ISC, 0BSD and those in ``license_texts``, as
published: Apache 2.0, Artistic 1.0 (Perl), BSD with two and three clauses, CC0 1.0, GFDL 1.2
and 1.3, GPL 1 to 3, LGPL 2 to 3, MPL 1.1 and 2.0, Unlicense. Each is known under its usual
titles, with and without the advice that follows its terms or "All rights reserved."
before them (``VARIANTS``). A text that names
its holder in a clause, as some of BSD do, is no known text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import LOWER, UPPER

MAX_KNOWN = 10_000

#: What a holder's line has and a clause wrapped before "copyright" lacks: a year or the place
#: for one, an address, or words that end a name. A bare name can't be told from a clause.
_YEAR = r"(\b(19|20)[0-9][0-9]\b|[<\[{(](yyyy|years?)\b)"
_NAMED = (
    r"(@|\b(inc|ltd|llc|gmbh|corp|corporation|foundation)\b|\band (other|individual) contributors\b"
    r"|[ \t]the [^\n]*\b(authors|contributors|developers|team|project)\b|[ \t]contributors to\b)"
)
#: Lines that name a holder differ from copy to copy; marks of comments may stand before them.
COPYRIGHT_LINE = (
    r"(^|\n)[ \t\r]*((dnl|rem)\b)?[ \t\r#*/;%!<>|-]*("
    rf"(portions )?copyright[ \t:]*(\(c\)|©|&copy;)|copyright\b[^\n]*({_YEAR}|{_NAMED})"
    rf"|\(c\)[ \t]*copyright\b|\(c\)[^\n]*({_YEAR}|{_NAMED})|©|&copy;)[^\n]*"
)
#: Anything but ASCII letters, digits and letters beyond ASCII separates words.
SEPARATORS = r"[^a-z0-9\x{00C0}-\x{1FFF}\x{2C00}-\x{10FFFF}]+"
#: Spellings that licence guidelines treat as the same word: (pattern of whole words, one form).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("noncommercial", "non commercial"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https", "http"),
)

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted{condition}.\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
#: Public licence texts and the usual notices that stand for one (fixed values).
KNOWN = {
    "MIT": "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
    "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software.\n\n" + _WARRANTY,
    "ISC": _ISC.format(
        condition=", provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "0BSD": _ISC.format(condition=""),
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}


#: Titles that stand before one and the same text.
TITLES = {
    "MIT": ("", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "ISC": ("", "ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("", "BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD", "0BSD License"),
    "BSD-2-Clause": (
        "", "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "2-Clause BSD License",
        'BSD 2-Clause "Simplified" License', "Simplified BSD License", "FreeBSD License", "BSD License",
        "The BSD License",
    ),
    "BSD-3-Clause": (
        "", "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "3-Clause BSD License",
        'BSD 3-Clause "New" or "Revised" License', "New BSD License", "The New BSD License", "Modified BSD License",
        "Revised BSD License", "BSD License", "The BSD License",
    ),
    "Unlicense": ("", "Unlicense", "The Unlicense", "The Unlicense (Unlicense)"),
}


def _published() -> dict[str, str]:
    folder = resources.files(__package__) / "license_texts"
    files = sorted((f for f in folder.iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in files}


KNOWN |= _published()


def _bodies(name: str, text: str) -> list[str]:
    """A known text without its title, in the wordings that are in use."""
    if name == "MIT":
        text = text.removeprefix("MIT License\n\n")
        return [text, text.replace("permission notice shall", "permission notice (including the next paragraph) shall")]
    if name in ("ISC", "0BSD"):
        return [text, text.replace("and/or distribute", "and distribute")]
    if name.startswith("BSD-"):
        plain = [text, re.sub(r"(?m)^\d\. ", "* ", text)]
        return [*plain, *[t.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR") for t in plain]]
    terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
    return [text, terms, terms + end] if end else [text]


#: Further (license_id, text) of the licences in ``KNOWN``.
VARIANTS = [
    (name, f"{title}\n\n{rights}\n\n{body}")
    for name, text in KNOWN.items()
    if not name.endswith("-notice")
    for body in _bodies(name, text)
    for title in TITLES.get(name, ("",))
    for rights in (("", "All rights reserved.") if name in TITLES else ("",))
]


def known_rows(known: Mapping[str, str]) -> list[tuple[str, str]]:
    """(license_id, text) of all known texts; ours come with their variants."""
    return [*known.items(), *(VARIANTS if known is KNOWN else ())]


def canonical(text: Column) -> Column:
    """The canonical form of a text; NULL counts as empty."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT_LINE, "$1")
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, SEPARATORS, " ")), F.lit(" "))
    for spelling, form in SPELLINGS:
        out = F.replace(out, F.lit(f" {spelling} "), F.lit(f" {form} "))
    return F.trim(out)


def canonical_sql(text: str) -> str:
    """The same form in SQL, for checking."""
    out = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    out = f"regexp_replace({out}, '{COPYRIGHT_LINE}', '\\1', 'g')"
    out = f"' ' || trim(regexp_replace({out}, '{SEPARATORS}', ' ', 'g')) || ' '"
    for spelling, form in SPELLINGS:
        out = f"replace({out}, ' {spelling} ', ' {form} ')"
    return f"trim({out})"


def license_lookup(
    docs: DataFrame, known: Mapping[str, str] = KNOWN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, canonical_sha256, license_id) for every row; license_id is NULL if unknown.

    The whole canonical text must equal a known one. NULL and empty texts, and texts without
    any word, have the digest of the empty text and are no licence, whatever ``known`` holds.
    Of known licences with one canonical form the first name in order counts. Repeated rows
    and NULL ids stay rows of their own. Other columns are ignored; an empty table gives an
    empty result.
    """
    if len(known) > MAX_KNOWN:
        raise ValueError(f"at most {MAX_KNOWN} known licences can be looked up at once")
    spark = docs.sparkSession
    listed = spark.createDataFrame(known_rows(known) or [("", "")], "license_id string, body string")
    digest = F.sha2(F.col("form").cast("binary"), 256).alias("canonical_sha256")
    forms = listed.select("license_id", canonical(F.col("body")).alias("form")).where("form <> ''")
    digests = forms.groupBy(digest).agg(F.min("license_id").alias("license_id"))
    rows = docs.select(F.col(id_col).alias("doc_id"), canonical(F.col(text_col).cast("string")).alias("form"))
    return (
        rows.select("doc_id", digest)
        .join(F.broadcast(digests), "canonical_sha256", "left")
        .select("doc_id", "canonical_sha256", "license_id")
    )
