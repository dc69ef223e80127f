"""Licence scan: canonical digests of entire texts, looked up in known ones.

A text is made canonical -- lower-cased, lines that only state a copyright dropped, spellings
that licence matching guidelines call equivalent made one, signs other than
letters and digits turned to single spaces -- and its SHA-256 is joined with
those of known licences and licence notices made canonical the same way.  The
text as a whole is looked up, and each of its lines as a text of its own (a
notice is often one line of a document).

All of it is built-in column functions.  The table of known digests is
broadcast by Spark only if it is small; a digest shared by a third of all rows
is one row on the known side.

Defined results: a null text is empty; an empty canonical text has no digest
and matches nothing; of known entries with equal digests all are named; rows
repeated or without id give a row each; an empty table gives an empty one;
further columns are ignored.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, pick

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: fixed values: spellings that count as the same, replaced in this order
SPELLINGS = (
    ("licence", "license"), ("licencing", "licensing"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"), ("merchantibility", "merchantability"), ("organisation", "organization"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("acknowledgement", "acknowledgment"), ("judgement", "judgment"),
    ("favour", "favor"), ("behaviour", "behavior"), ("whilst", "while"), ("wilful", "willful"), ("fulfil ", "fulfill "), ("per cent", "percent"),
    ("https://", "http://"), ("&", " and "), ("copyright holder", "copyright owner"),
)
#: what follows "copyright" in running text, so that a line which begins with it is no notice of a name
_RUNNING = ("holders?|owners?|ownership|notices?|laws?|licen[cs]es?|statements?|permissions?|interests?|disclaimers?|treaty|treaties|protections?|"
            "acts?|claims?|status|works?|rights?|infringements?|doctrines?|exceptions?|restrictions?|limitations?|assignments?|terms?|material|"
            "information|headers?|lines?|and|or|on|in|of|to|is|are|was|were|be|been|the|this|that|these|those|a|an|any|all|as|at|for|from|under|with|"
            "within|which|who|may|shall|must|can|will|would|if|it|its|has|have|had|not|your|you|we|our|their|each|such|other|only|except|but|than")
_YEAR = "[\\[<{(]?(?:(?:19|20)[0-9]{2}|19yy|yyyy|year\\b)"
_GROUP = "(?:authors|contributors|developers|foundation|project|team|regents|university|inc|ltd|llc|gmbh|corp|corporation|company)\\b"
#: a line that only states a copyright (of lower-cased text): by a mark, a year or a name
COPYRIGHT_NOTICE = (r"(?m)^[ \t*#/;-]*(?:©|all rights reserved|copyright[ \t:,]*(?:\(c\)|©|&copy;)|"
                    rf"(?:copyright|\(c\)|&copy;)(?:[ \t:,]|copyright\b|by\b)*{_YEAR}|"
                    rf"copyright(?::|[ \t]+by\b)?[ \t]+(?!by\b)(?:(?!(?:{_RUNNING})\b)[^\s(\[<{{]|the[ \t][^\n,;]*{_GROUP}(?:[ .]*$|[^\n]*all rights reserved))|"
                    rf"\(c\)[ \t]+(?!(?:{_RUNNING})\b)[^\n;]*{_GROUP}[ .]*$)[^\n]*$")
#: signs that separate words (line feeds are kept until the lines are told apart)
SIGNS = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F\\x{A0}©®«»‐‑‒–—―‘’“”•…™]+"


def canonical(text: Column) -> Column:
    """Canonical form with its line feeds."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_NOTICE, "")
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.regexp_replace(out, SIGNS, " ")


def line_of(canonical_text: Column) -> Column:
    """A canonical text in one line with single spaces."""
    line = F.trim(F.regexp_replace(canonical_text, "[ \\n]+", " "))
    for one, other in SPELLINGS:
        if " " in one.strip():                          # its words may stand on two lines
            line = F.replace(line, F.lit(one), F.lit(other))
    return line


def digest(canonical_text: Column) -> Column:
    """SHA-256 of a canonical text in one line; null if nothing is left."""
    line = line_of(canonical_text)
    return F.when(line != "", F.sha2(line, 256))


def known_digests(known: DataFrame, id_col: str = "license_id", text_col: str = "text") -> DataFrame:
    """(digest, license_id, lengths) of known texts; entries with equal digests
    share a row; ``lengths``: of their canonical lines."""
    c = canonical(F.col("text"))
    own = pick(known, license_id=id_col, text=text_col).select("license_id", digest(c).alias("digest"), F.length(line_of(c)).alias("length"))
    return own.where("digest is not null").groupBy("digest").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("license_id"),
                                                                 F.collect_set("length").alias("lengths"))


def whole_texts() -> list[tuple[str, str]]:
    """(license_id, text) of entire licences as files hold them: those of
    ``license_texts`` and of ``KNOWN``, with and without title and appendix."""
    out = set(KNOWN.items())
    for name, titles in TITLES.items():
        bodies = {KNOWN[name], re.sub(r"(?m)^[0-9]\. ", "", KNOWN[name])}          # numbered, or with signs as bullets
        if name == "BSD-3-Clause":
            regents = _text("BSD")
            bodies |= {regents, re.sub(r"(?m)^[0-9]\. ", "", regents)}
        out.update((name, f"{t}\n\n{b}") for t in ("", *titles) for b in bodies)
    for name, (license_id, titles) in FILES.items():
        text = _text(name)
        found = [text[at:] for m in [re.match(r"(?:\s*\S[^\n]*\n){%d}" % titles, text)] for at in (0, m.end())]
        for body in found:
            ends = [m.start() for m in _APPENDIX.finditer(body)] + [m.end() for m in re.finditer("END OF TERMS AND CONDITIONS", body)]
            for part in {body, *(body[:e] for e in ends)}:
                out.update((license_id, _ADDRESS.sub(a, part)) for a in _ADDRESSES)
                out.add((license_id, part))
    return sorted(out)


def _text(name: str) -> str:
    return resources.files(__package__).joinpath("license_texts", f"{name}.txt").read_text("utf-8")


def default_known(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(whole_texts(), "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, license_id, notices): the licence that the entire text
    is (else null), and those that lines of it are (sorted, comma-joined)."""
    table = keep(known_digests(known), "licenses")
    # a line can only equal a known text of its length: other lines need no digest
    lengths = sorted(r[0] for r in table.select(F.explode("lengths")).distinct().collect())      # at most as many as the longest known text has signs
    own = pick(docs, doc_id=id_col, text=text_col).select("doc_id", canonical(F.col("text")).alias("c"))
    plain = F.transform(F.split("c", "\n"), line_of)
    lines = F.transform(F.filter(plain, lambda x: F.length(x).isin(lengths)), lambda x: F.sha2(x, 256))
    # written once: the canonical text is long to make, what is left of it is short
    rows = keep(own.select("doc_id", F.xxhash64("c").alias("row_key"), digest(F.col("c")).alias("digest"),
                           F.array_distinct(lines).alias("lines")), "canonical")        # rows equal in id and canonical text have equal notices
    table = table.select("digest", "license_id")
    found = rows.select("doc_id", "row_key", F.explode("lines").alias("line"))
    notices = (found.join(table, found["line"] == table["digest"]).groupBy("doc_id", "row_key")
               .agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
               .select(F.col("doc_id").alias("n_id"), F.col("row_key").alias("n_key"), "notices"))
    return (rows.drop("lines").join(table, "digest", "left")
            .join(notices, F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("row_key") == F.col("n_key")), "left")
            .select("doc_id", "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices")))


def oracle(known: dict[str, str] | None = None) -> str:
    """DuckDB SQL for ``scan`` of ``documents`` by the given known texts."""
    def quoted(s):
        return "'" + s.replace("'", "''") + "'"

    def notice(x):
        """``COPYRIGHT_NOTICE`` for one line, without looking ahead."""
        start = "^[ \\t*#/;-]*"
        rest = f"regexp_extract({x}, '{start}copyright(?::|[ \\t]+by\\b)?[ \\t]+(.*)$', 1)"
        after = f"regexp_extract({x}, '{start}\\(c\\)[ \\t]+(.*)$', 1)"
        has = lambda text, pattern: f"regexp_matches({text}, '{pattern}')"
        return "(" + " OR ".join([
            has(x, f"{start}(?:©|all rights reserved|copyright[ \\t:,]*(?:\\(c\\)|©|&copy;))"),
            has(x, f"{start}(?:copyright|\\(c\\)|&copy;)(?:[ \\t:,]|copyright\\b|by\\b)*{_YEAR}"),
            f"({has(rest, '^[^ ' + chr(92) + 't(' + chr(92) + '[<{]')} AND NOT {has(rest, f'^(?:by|{_RUNNING})' + chr(92) + 'b')})",
            has(rest, f"^the[ \\t][^,;]*{_GROUP}(?:[ .]*$|.*all rights reserved)"),
            f"({has(after, f'^[^;]*{_GROUP}[ .]*$')} AND NOT {has(after, f'^(?:{_RUNNING})' + chr(92) + 'b')})"]) + ")"

    def canon(x):
        out = f"array_to_string(list_transform(string_split(lower(coalesce({x}, '')), chr(10)), lambda l: CASE WHEN {notice('l')} THEN '' ELSE l END), chr(10))"
        for one, other in SPELLINGS:
            out = f"replace({out}, '{one}', '{other}')"
        return f"regexp_replace({out}, '{SIGNS}', ' ', 'g')"

    def dig(x):
        line = f"trim(regexp_replace({x}, '[ \\n]+', ' ', 'g'), ' ')"
        for one, other in SPELLINGS:
            if " " in one.strip():
                line = f"replace({line}, '{one}', '{other}')"
        return f"CASE WHEN {line} <> '' THEN sha256({line}) END"

    values = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in sorted((known or KNOWN).items()))
    return f"""
WITH known AS (SELECT {dig('c')} AS digest, license_id FROM (SELECT license_id, {canon('t')} AS c FROM (VALUES {values}) AS v(license_id, t))),
known1 AS (SELECT digest, string_agg(license_id, ',' ORDER BY license_id) AS license_id FROM known WHERE digest IS NOT NULL GROUP BY 1),
own AS (SELECT row_number() OVER () AS r, doc_id, {canon('text')} AS c FROM documents),
lines AS (SELECT DISTINCT r, {dig('line')} AS digest FROM (SELECT r, unnest(string_split(c, chr(10))) AS line FROM own)),
notices AS (SELECT r, string_agg(license_id, ',' ORDER BY license_id) AS notices FROM lines JOIN known1 USING (digest) GROUP BY 1),
whole AS (SELECT r, doc_id, {dig('c')} AS digest FROM own)
SELECT doc_id, whole.digest AS digest, license_id, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known1 ON whole.digest = known1.digest LEFT JOIN notices USING (r)"""


_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR
IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT
OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
#: fixed values: licence texts and notices looked up by default
KNOWN = {
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_END,
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": _BSD_START + _BSD_END,
    "BSD-3-Clause": _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                    "products derived from this software without specific prior written permission.\n" + _BSD_END,
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
           "the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END,
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
           '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
           "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
           "the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial "
           "portions of the Software.\n\n" + _AS_IS + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
           "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
           "OTHER DEALINGS IN THE SOFTWARE.",
    "MIT notice": "Released under the MIT License.",
}
#: fixed values: title lines that files put before a text of ``KNOWN``
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD", "BSD 0-Clause License", "Free Public License 1.0.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License',
                     "Simplified BSD License", "BSD License", "The BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License',
                     "New BSD License", "Modified BSD License", "Revised BSD License", "BSD License", "The BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT", "MIT/X11 License", "Expat License"),
}
#: fixed values: file of ``license_texts`` -> its licence, and how many title lines it begins with
FILES = {
    "Apache-2.0": ("Apache-2.0", 3), "Artistic": ("Artistic-1.0-Perl", 1), "CC0-1.0": ("CC0-1.0", 1), "GFDL-1.2": ("GFDL-1.2", 2), "GFDL-1.3": ("GFDL-1.3", 2),
    "GPL-1": ("GPL-1.0", 2), "GPL-2": ("GPL-2.0", 2), "GPL-3": ("GPL-3.0", 2), "LGPL-2": ("LGPL-2.0", 2), "LGPL-2.1": ("LGPL-2.1", 2),
    "LGPL-3": ("LGPL-3.0", 2), "MPL-1.1": ("MPL-1.1", 2), "MPL-2.0": ("MPL-2.0", 1),
}
_APPENDIX = re.compile(r"(?m)^[ \t]*(?:END OF TERMS AND CONDITIONS|(?:APPENDIX: )?How to apply the Apache|(?:Appendix: )?How to Apply These Terms|"
                       r"ADDENDUM: How to use|Exhibit A - Source|EXHIBIT A -Mozilla)")
#: addresses that the texts of the Free Software Foundation have had
_ADDRESS = re.compile(r"51 Franklin St(?:reet)?, Fifth Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA")
_ADDRESSES = ("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
              "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA",
              "675 Mass Ave, Cambridge, MA 02139, USA")
