"""Licence scans by sentence rules, in column functions only.

A text is cut into sentences, each is normalised (ASCII letters and digits in
lower case, single spaces) and looked up among known licence sentences.  A
document becomes the sequence of identifiers it holds, and ordered licence
rules are matched against that sequence: a rule names the identifiers that must
follow each other, with at most GAP unknown sentences in between.

A text is read twice.  By lines every line break ends a sentence, as notices on a
line of their own need.  As a whole a line break is a blank, as wrapped licence
texts need; there the sentences of whole licences are known too.

Defined results: null or empty text holds no sentence and no licence; repeated
sentences repeat in the sequence but a rule is reported once; rules are reported
in the order of RULES and `license` is the first of them; "all rights reserved" alone
counts only where no licence is found, BSD's grant only where its clauses are not; an empty table gives
an empty table; repeated rows get equal results; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: licence sentences and rules --------------------------------
SENTENCES = {
    "apache_notice": "licensed under the apache license version 2 0",
    "apache_grant": "licensed under the apache license version 2 0 the license",
    "apache_use": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_law": ("unless required by applicable law or agreed to in writing software distributed under the "
                   "license is distributed on an as is basis without warranties or conditions of any kind either "
                   "express or implied"),
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_notice": "released under the mit license",
    "mit_notice2": "licensed under the mit license",
    "mit_grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files the software to deal in the software without restriction"),
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied",
    "gpl3_notice": "this work is licensed under the gnu general public license version 3",
    "gpl3_notice2": "licensed under the gnu general public license version 3",
    "gpl_free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 3 of the "
                 "license or at your option any later version"),
    "gpl_hope": ("this program is distributed in the hope that it will be useful but without any warranty without "
                 "even the implied warranty of merchantability or fitness for a particular purpose"),
    "ccbync_notice": "licensed under cc by nc 4 0",
    "ccbync_notice2": ("this work is licensed under a creative commons attribution noncommercial 4 0 international "
                       "license"),
    "ccby_notice": "licensed under cc by 4 0",
    "ccby_notice2": "this work is licensed under a creative commons attribution 4 0 international license",
    "bsd_grant": ("redistribution and use in source and binary forms with or without modification are permitted "
                  "provided that the following conditions are met"),
    "rights": "all rights reserved",
}
# Notices of one sentence, by licence.
NOTICES = {
    "GPL-2.0": ("licensed under the gnu general public license version 2",),
    "LGPL-2.1": ("licensed under the gnu lesser general public license version 2 1",),
    "LGPL-3.0": ("licensed under the gnu lesser general public license version 3",),
    "AGPL-3.0": ("licensed under the gnu affero general public license version 3",),
    "MPL-2.0": ("licensed under the mozilla public license version 2 0",),
    "EPL-2.0": ("licensed under the eclipse public license version 2 0",),
    "ISC": ("licensed under the isc license",),
    "BSD-3-Clause": ("licensed under the bsd 3 clause license",),
    "BSD-2-Clause": ("licensed under the bsd 2 clause license",),
    "CC-BY-SA-4.0": ("licensed under cc by sa 4 0",
                     "this work is licensed under a creative commons attribution sharealike 4 0 international license",
                     "this work is licensed under the creative commons attribution sharealike 4 0 international license"),
}
# Identifiers that may follow "SPDX-License-Identifier:", by licence.
_GNU = ("", "-only", "-or-later")
SPDX = {
    **{name: (name,) for name in ("Apache-2.0", "MIT", "CC-BY-NC-4.0", "CC-BY-4.0", "MPL-2.0", "EPL-2.0", "ISC", "0BSD",
                                  "BSD-3-Clause", "BSD-2-Clause", "CC-BY-SA-4.0", "CC0-1.0", "Unlicense")},
    **{name: tuple(name + end for end in _GNU) for name in ("GPL-3.0", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")},
}


def _spoken(identifier: str) -> str:
    return "".join(c if c.isalnum() else " " for c in identifier.lower())


_MARKED = [(name, f"{kind}_{_spoken(name).replace(' ', '_')}_{i}", words)
           for kind, table in (("notice", NOTICES),
                               ("spdx", {n: tuple(f"spdx license identifier {_spoken(x)}" for x in ids) for n, ids in SPDX.items()}))
           for name, forms in table.items() for i, words in enumerate(forms)]
SENTENCES |= {ident: words for _, ident, words in _MARKED}
RULES = (  # (licence, identifiers in order); longer evidence first
    ("Apache-2.0", ("apache_grant", "apache_use", "apache_copy")),
    ("Apache-2.0", ("apache_law", "apache_see")),
    ("Apache-2.0", ("apache_notice",)),
    ("MIT", ("mit_grant", "mit_warranty")),
    ("MIT", ("mit_notice",)),
    ("MIT", ("mit_notice2",)),
    ("GPL-3.0", ("gpl_free", "gpl_hope")),
    ("GPL-3.0", ("gpl3_notice",)),
    ("GPL-3.0", ("gpl3_notice2",)),
    ("CC-BY-NC-4.0", ("ccbync_notice",)),
    ("CC-BY-NC-4.0", ("ccbync_notice2",)),
    ("CC-BY-4.0", ("ccby_notice",)),
    ("CC-BY-4.0", ("ccby_notice2",)),
    *((name, (ident,)) for name, ident, _ in _MARKED),
    ("BSD", ("bsd_grant",)),
    ("Proprietary", ("rights",)),
)
GENERAL = {  # licences that count only where none of the others is found (no list: none at all)
    "BSD": ("BSD-3-Clause", "BSD-2-Clause"),
    "Proprietary": (),
}
END = r"[.!?]+([\x20\x09-\x0D]+|$)|[\n\r]+"  # ends a sentence

# Sentences of whole licence texts, wrapped or not.
_APACHE_TERMS = SENTENCES["apache_grant"] + " " + SENTENCES["apache_use"]
_APACHE_AT = "you may obtain a copy of the license at"
_APACHE_URLS = ("http www apache org licenses license 2 0", "https www apache org licenses license 2 0")
_GPL = ("this {0} is free software you can redistribute it and or modify it under the terms of the gnu {1} public license as "
        "published by the free software foundation {2}")
_LATER = " of the license or at your option any later version"
FULL_SENTENCES = {
    "apache_terms": (_APACHE_TERMS,),
    "apache_at": (_APACHE_AT, *_APACHE_URLS, *(f"{_APACHE_AT} {u}" for u in _APACHE_URLS)),
    "apache_at_law": tuple(f"{u} {SENTENCES['apache_law']}" for u in (*_APACHE_URLS, *(f"{_APACHE_AT} {u}" for u in _APACHE_URLS))),
    "mit_full_grant": (
        SENTENCES["mit_grant"] + " including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions",),
    "mit_keep": ("the above copyright notice and this permission notice shall be included in all copies or substantial "
                 "portions of the software",
                 "the above copyright notice and this permission notice including the next paragraph shall be included in "
                 "all copies or substantial portions of the software"),
    "mit_full_warranty": (
        SENTENCES["mit_warranty"] + " including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement",),
    "mit_liable": ("in no event shall the authors or copyright holders be liable for any claim damages or other liability "
                   "whether in an action of contract tort or otherwise arising from out of or in connection with the "
                   "software or the use or other dealings in the software",),
    "gpl_details": ("see the gnu general public license for more details",),
    "gpl_copy": ("you should have received a copy of the gnu general public license along with this program",),
    "gpl_see": ("if not see http www gnu org licenses", "if not see https www gnu org licenses"),
    "bsd_source": ("redistributions of source code must retain the above copyright notice this list of conditions and the "
                   "following disclaimer",),
    "bsd_binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and "
                   "the following disclaimer in the documentation and or other materials provided with the distribution",),
    "bsd_name": tuple(
        f"neither the name of {holder} nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission"
        for holder in ("the copyright holder", "the copyright holders", "the organization")),
    "bsd_warranty": tuple(
        f"this software is provided by the copyright {holders} and contributors as is and any express or implied "
        "warranties including but not limited to the implied warranties of merchantability and fitness for a particular "
        "purpose are disclaimed" for holders in ("holders", "holder")),
    "bsd_liable": tuple(
        f"in no event shall the copyright {holder} or contributors be liable for any direct indirect incidental special "
        "exemplary or consequential damages including but not limited to procurement of substitute goods or services loss "
        "of use data or profits or business interruption however caused and on any theory of liability whether in contract "
        "strict liability or tort including negligence or otherwise arising in any way out of the use of this software even "
        "if advised of the possibility of such damage" for holder in ("holder", "holders", "owner")),
    "gpl2_free": (_GPL.format("program", "general", "either version 2") + _LATER,
                  "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license version 2 as published by the free software foundation"),
    "lgpl21_free": tuple(_GPL.format(what, "lesser general", "either version 2 1") + _LATER for what in ("library", "program")),
    "lgpl3_free": tuple(_GPL.format(what, "lesser general", "either version 3") + _LATER for what in ("library", "program")),
    "agpl3_free": tuple(_GPL.format("program", "affero general", f"{version} 3") + _LATER for version in ("either version", "version")),
    "lgpl_hope": (SENTENCES["gpl_hope"].replace("this program", "this library"),),
    "lgpl_details": ("see the gnu lesser general public license for more details",),
    "agpl_details": ("see the gnu affero general public license for more details",),
    "mpl_terms": ("this source code form is subject to the terms of the mozilla public license v",),
    "mpl_copy": tuple("if a copy of the mpl was not distributed with this file you can obtain one at "
                      f"{http} mozilla org mpl 2 0" for http in ("http", "https")),
    "epl_terms": tuple("this program and the accompanying materials are made available under the terms of the eclipse public "
                       f"license {v} which is available at {http} www eclipse org legal epl 2 0"
                       for v in ("2 0", "v 2 0", "v2 0") for http in ("http", "https")),
    "isc_grant": tuple(f"permission to use copy modify {how} distribute this software for any purpose with or without fee is "
                       "hereby granted provided that the above copyright notice and this permission notice appear in all copies"
                       for how in ("and or", "and")),
    "0bsd_grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
                   "hereby granted",),
    "isc_warranty": tuple(f"the software is provided as is and {who} all warranties with regard to this software including "
                          "all implied warranties of merchantability and fitness"
                          for who in ("the author disclaims", "the authors disclaim")),
    "un_free": ("this is free and unencumbered software released into the public domain",),
    "un_anyone": ("anyone is free to copy modify publish use compile sell or distribute this software either in source code "
                  "form or as a compiled binary for any purpose commercial or non commercial and by any means",),
    "cc0_dedicate": tuple(f"to the extent possible under law {who} dedicated all copyright and related and neighboring rights "
                          "to this software to the public domain worldwide"
                          for who in ("the author s have", "the author has", "the authors have")),
}
FULL_RULES = (  # matched beside RULES, on whole sentences
    ("Apache-2.0", ("apache_terms",)),
    ("Apache-2.0", ("apache_at_law", "apache_see")),
    ("MIT", ("mit_full_grant", "mit_keep", "mit_full_warranty")),
    ("MIT", ("mit_full_grant", "mit_full_warranty")),
    ("GPL-2.0", ("gpl2_free", "gpl_hope")),
    ("LGPL-2.1", ("lgpl21_free", "lgpl_hope")),
    ("LGPL-2.1", ("lgpl21_free", "gpl_hope")),
    ("LGPL-3.0", ("lgpl3_free", "lgpl_hope")),
    ("LGPL-3.0", ("lgpl3_free", "gpl_hope")),
    ("AGPL-3.0", ("agpl3_free", "gpl_hope")),
    ("MPL-2.0", ("mpl_terms", "mpl_copy")),
    ("EPL-2.0", ("epl_terms",)),
    ("ISC", ("isc_grant", "isc_warranty")),
    ("0BSD", ("0bsd_grant", "isc_warranty")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_name")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_warranty")),
    ("CC0-1.0", ("cc0_dedicate",)),
    ("Unlicense", ("un_free", "un_anyone")),
)
# Ends a whole sentence: an end mark, the head of a list of conditions, a blank line.
FULL_END = (r"[.!?]+([\x20\x09-\x0D]+|$)|:(?<=(?i:conditions|are met):)[\x20\x09-\x0D]+"
            r"|(?>\r\n|\r|\n)[^A-Za-z0-9]*[\r\n]")
# A copyright line is a sentence of its own.
COPYRIGHT = r"(?im)^([^A-Za-z0-9\r\n]*copyright[\x20\t]+(?:\(c\)|[\d©<\[])[^\r\n]*)$"
# -------------------------------------------------------------------------------

GAP = 2
UNKNOWN = "."


def sentences(text: Column) -> Column:
    """Normalised sentences, blank ones left out."""
    cut = F.regexp_replace(F.coalesce(text, F.lit("")), END, "\n")
    plain = F.lower(F.regexp_replace(F.regexp_replace(cut, r"[^A-Za-z0-9\n]+", " "), r" ?\n ?", "\n"))
    return F.array_remove(F.transform(F.split(plain, "\n"), lambda s: F.trim(s)), "")


def full_sentences(text: Column) -> Column:
    """Normalised sentences of a text in which a line break is a blank: only end
    marks, blank lines and heads of lists end one."""
    own = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT, "\n\n$1\n\n")
    # \x00 stands for an end, as line breaks are blanks here
    cut = F.regexp_replace(F.translate(own, "\x00", " "), FULL_END, "\x00")
    plain = F.lower(F.regexp_replace(cut, r"[^A-Za-z0-9\x00]+", " "))
    return F.array_remove(F.transform(F.split(plain, "\x00"), lambda s: F.trim(s)), "")


_NAMES = {words: ident for ident, words in SENTENCES.items()}
_FULL_NAMES = _NAMES | {words: ident for ident, forms in FULL_SENTENCES.items() for words in forms}


def identifiers(sents: str, names: dict[str, str] = _NAMES) -> Column:
    """`sents` as a text of identifiers with blanks around each, `.` where unknown."""
    known = F.lit(None).cast("string")
    def name(s):
        out = F.lit(UNKNOWN)
        for words, ident in names.items():
            out = F.when(s == words, ident).otherwise(out)
        return out
    any_known = F.arrays_overlap(sents, F.array(*[F.lit(w) for w in names]))
    ids = F.transform(sents, lambda s: F.when(s.isin(*names), name(s)).otherwise(UNKNOWN))
    return F.when(any_known, F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))).otherwise(known)


def rule_pattern(idents: tuple[str, ...]) -> str:
    """Regular expression of an ordered rule over the identifier text."""
    return " " + rf"( \.){{0,{GAP}}} ".join(idents) + " "


OUTPUTS = ("n_sentences", "licenses", "license")


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with `n_sentences` (licence sentences found, by the reading that finds
    more), `licenses` (all that match in either reading, joined by commas, in the
    order of RULES) and `license` (the first)."""
    own = [c for c in df.columns if c not in OUTPUTS]
    out = df.select(*[F.col(c).alias(f"own_{i}") for i, c in enumerate(own)], F.col(text).alias("_text"))
    out = out.withColumn("_sents", sentences(F.col("_text"))).withColumn("_full", full_sentences(F.col("_text")))
    out = out.withColumn("_ids", identifiers("_sents")).withColumn("_full_ids", identifiers("_full", _FULL_NAMES))
    order = list(dict.fromkeys(n for n, _ in RULES))
    named = F.array(*[F.when(F.coalesce(_matches(n), F.lit(False)), F.lit(n)) for n in order])
    known = F.col("_ids").isNotNull() | F.col("_full_ids").isNotNull()
    out = out.withColumn("_found", F.when(known, F.array_compact(named)).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("_all", F.filter("_found", _counts))
    count = lambda c, names: F.size(F.filter(c, lambda s: s.isin(*names)))
    return out.select(
        *[F.col(f"own_{i}").alias(c) for i, c in enumerate(own)],
        F.when(known, F.greatest(count("_sents", _NAMES), count("_full", _FULL_NAMES))).otherwise(0).cast("long").alias("n_sentences"),
        F.array_join("_all", ",").alias("licenses"),
        F.get("_all", F.lit(0)).alias("license"),
    )


def _counts(name: Column) -> Column:
    """A licence of GENERAL counts only without a licence that says more."""
    out = F.lit(True)
    for general, others in GENERAL.items():
        more = F.arrays_overlap("_found", F.array(*map(F.lit, others))) if others else F.size("_found") > 1
        out = out & ((name != general) | ~more)
    return out


def _matches(license: str) -> Column:
    """Does a rule of `license` match in either reading?"""
    found = F.lit(False)
    for name, idents in (*RULES, *FULL_RULES):
        if name == license:
            pattern = rule_pattern(idents)
            if (name, idents) in RULES:
                found = found | F.coalesce(F.col("_ids").rlike(pattern), F.lit(False))
            found = found | F.coalesce(F.col("_full_ids").rlike(pattern), F.lit(False))
    return found


def license_rows(docs: DataFrame) -> DataFrame:
    """Query form over `documents`, one row per document."""
    return scan(docs.select("doc_id", "text")).select("doc_id", *OUTPUTS)
