"""License scans by sentence rules.

A text is cut into sentences, each sentence is normalised (lower case, words
and numbers only, comment marks gone) and looked up among the sentences known
from licences, which gives its identifier; a notice that names a licence ("this work is
released under the ...") is read by a small grammar instead.  A text is then
the sequence of the identifiers it holds; ordered rules, the longest first, match runs of that
sequence and name the licence.  A rule may step over a few foreign sentences
(names and years stand between licence sentences), but not over known ones.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, normalised, by
# identifier; <> stands for words that differ from text to text.
SENTENCES = {
    "apache2-under": "licensed under the apache license version 2.0",
    "apache2-under-the": "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
    "apache2-comply": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at",
    "apache2-url": "you may obtain a copy of the license at http www apache org licenses license 2.0",
    "apache2-unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-under": "licensed under the mit license",
    "mit-released": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-grant-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-liability": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-advert": "all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by <>",
    "bsd-names": "neither the name of <> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-warranty": "this software is provided by <> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liability": "in no event shall <> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "bsd-under": "use of this source code is governed by a bsd style license that can be found in the license file",
    "gpl2-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3-later": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl21-later": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version",
    "gnu-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gnu-library-warranty": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "agpl-see": "see the gnu affero general public license for more details",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2.0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "cc0": "to the extent possible under law <> has waived all copyright and related or neighboring rights to <>",
    "cc-by4": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc-by4-the": "this work is licensed under the creative commons attribution 4.0 international license",
    "cc-by-sa4": "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    "cc-by-nc4": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    "boost-under": "distributed under the boost software license version 1.0",
    "epl2-under": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0",
    "rights": "all rights reserved",
}
# Ordered rules, sequences of sentence identifiers.
RULES = [
    ("Apache-2.0", "apache2-under-the apache2-url apache2-unless apache2-see"),
    ("Apache-2.0", "apache2-under-the apache2-copy apache2-unless apache2-see"),
    ("Apache-2.0", "apache2-under apache2-comply apache2-url apache2-unless apache2-see"),
    ("Apache-2.0", "apache2-under apache2-comply apache2-copy apache2-unless apache2-see"),
    ("Apache-2.0", "apache2-under-the apache2-url"),
    ("Apache-2.0", "apache2-under apache2-url"),
    ("Apache-2.0", "apache2-under-the"),
    ("Apache-2.0", "apache2-under"),
    ("MIT", "mit-grant mit-notice mit-warranty mit-liability"),
    ("MIT", "mit-grant-notice mit-warranty mit-liability"),
    ("MIT", "mit-grant mit-notice"),
    ("MIT", "mit-under"),
    ("MIT", "mit-released"),
    ("ISC", "isc-grant isc-warranty isc-liability"),
    ("ISC", "isc-grant"),
    ("0BSD", "0bsd-grant isc-warranty isc-liability"),
    ("BSD-4-Clause", "bsd-grant bsd-source bsd-binary bsd-advert bsd-names bsd-warranty bsd-liability"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-names bsd-warranty bsd-liability"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary bsd-warranty bsd-liability"),
    ("BSD-style", "bsd-under"),
    ("GPL-2.0-or-later", "gpl2-later gnu-warranty gpl-see"),
    ("GPL-2.0-or-later", "gpl2-later"),
    ("GPL-2.0-only", "gpl2-only gnu-warranty gpl-see"),
    ("GPL-2.0-only", "gpl2-only"),
    ("GPL-3.0-or-later", "gpl3-later gnu-warranty gpl-see"),
    ("GPL-3.0-or-later", "gpl3-later"),
    ("AGPL-3.0-or-later", "agpl3-later gnu-warranty agpl-see"),
    ("AGPL-3.0-or-later", "agpl3-later"),
    ("LGPL-2.1-or-later", "lgpl21-later gnu-library-warranty lgpl-see"),
    ("LGPL-2.1-or-later", "lgpl21-later"),
    ("MPL-2.0", "mpl2-subject mpl2-copy"),
    ("MPL-2.0", "mpl2-subject"),
    ("Unlicense", "unlicense-free unlicense-anyone"),
    ("Unlicense", "unlicense-free"),
    ("CC0-1.0", "cc0"),
    ("CC-BY-4.0", "cc-by4"),
    ("CC-BY-4.0", "cc-by4-the"),
    ("CC-BY-SA-4.0", "cc-by-sa4"),
    ("CC-BY-NC-4.0", "cc-by-nc4"),
    ("BSL-1.0", "boost-under"),
    ("EPL-2.0", "epl2-under"),
]
BETWEEN = 2     # foreign sentences a rule may step over between its own

# "v. 2.0" ends no sentence
_SENTENCE = re.compile(r"(?:[^.!?\n]|(?<=\W[vV])\.(?=\s[0-9])|[.!?](?!\s|\Z)"
                       r"|\n(?![^\S\n]*\n))+")
_WORD = re.compile(r"[0-9]+(?:\.[0-9]+)*|[^\W_0-9]+|[0-9]+")
_SAYS = re.compile(r"(?i)licen[sc]|\bunder\b|public\s+domain")
_PLUS = re.compile(r"(?<=[0-9])\+(?![0-9+])")
_NUMBERING = re.compile(r"^(?:[0-9]+|[a-e]|\*|-)(?: |$)")
_LOWER = {c: c + 32 for c in range(65, 91)}
_NORMAL = {s: k for k, s in SENTENCES.items() if "<>" not in s}
# sentences with open places, by their first two words
_OPEN: dict[str, list[tuple[str, re.Pattern]]] = {}
for _k, _s in SENTENCES.items():
    if "<>" in _s:
        _OPEN.setdefault(" ".join(_s.split()[:2]), []).append((_k, re.compile(
            "(?:[^ ]+ ){0,15}?[^ ]+".join(
                re.escape(x) for x in _s.split("<>")) + r"\Z")))
_NAMES = "notice: "     # before the licences that a notice names
_FIRST = {s.split()[0] for s in SENTENCES.values()}
_LONGEST = max(len(s.split()) for s in SENTENCES.values()) + 40

# How notices name licences, on normalised words.  A version
# may follow a name; (family, pattern), the first that matches counts.
_LIC = "(?: licen[sc]es?)?"
FAMILIES = [
    ("AGPL", "(?:gnu )?(?:affero general public licen[sc]es?|agplv?)" + _LIC),
    ("LGPL", "(?:gnu )?(?:(?:lesser|library) (?:general )?public licen[sc]es?"
             "|lgplv?)" + _LIC),
    ("GFDL", "(?:gnu )?(?:free documentation licen[sc]es?|g?fdlv?)" + _LIC),
    ("GPL", "(?:gnu )?(?:general public licen[sc]es?|gplv?)" + _LIC),
    ("Apache", "(?:apache(?: software)?(?: foundation)?|asl)" + _LIC),
    ("MPL", "(?:mozilla public licen[sc]es?|mplv?)" + _LIC),
    ("EPL", "(?:eclipse public licen[sc]es?|epl)" + _LIC),
    ("EUPL", "(?:european union public licen[sc]es?|eupl)" + _LIC),
    ("CDDL", "(?:common development and distribution licen[sc]es?|cddl)"
             + _LIC),
    ("BSL", "boost(?: software)?" + _LIC + "|bsl(?= 1)" + _LIC),
    ("Artistic", "(?:perl )?artistic" + _LIC),
    ("OFL", "(?:sil )?(?:open font licen[sc]es?|ofl)" + _LIC),
    ("0BSD", "(?:0|zero) clause bsd|bsd (?:0|zero) clause|0 ?bsd"),
    ("BSD-2-Clause", "(?:2|two) clause (?:simplified )?bsd|bsd (?:2|two) "
     "clause(?: simplified)?|simplified bsd|freebsd"),
    ("BSD-3-Clause", "(?:3|three) clause (?:new |modified |revised )?bsd"
     "|bsd (?:3|three) clause(?: new)?(?: or)?(?: revised| modified)?"
     "|(?:new|modified|revised) bsd"),
    ("BSD-4-Clause", "(?:4|four) clause (?:original )?bsd|bsd (?:4|four) "
     "clause(?: original)?|original bsd"),
    ("BSD-style", "bsd"),
    ("MIT", "(?:mit|expat)(?: expat| x ?11)?"),
    ("ISC", "isc|internet systems consortium"),
    ("Zlib", "zlib(?: libpng)?"),
    ("WTFPL", "wtfpl|do what the fuck you want to public licen[sc]e"),
    ("Unlicense", "(?:the )?unlicen[sc]e"),
    ("CC0", "(?:creative commons )?cc ?0|creative commons zero"
     "|creative commons public domain dedication"),
    # the parts after "attribution" are read off by _CC_PARTS
    ("CC", "(?:(?:creative commons|cc)" + _LIC + " (?:attribution|by)"
     "|attribution(?= (?:non|share|no|[1-4])))(?: (?:nc|sa|nd|non ?commercial"
     "|share ?alike|no ?deriv(?:ative)?s?(?: works)?))*"),
]
# the version that is meant where there was one only
ONLY = {"Unlicense": "", "CC0": "1.0", "BSL": "1.0"}
_CC_PARTS = (("NC", re.compile(r"\b(?:nc|non ?commercial)\b")),
             ("SA", re.compile(r"\b(?:sa|share ?alike)\b")),
             ("ND", re.compile(r"\b(?:nd|no ?deriv)")))
_FAMILY = [(f, re.compile("(?:" + x + r")(?= |\Z)")) for f, x in FAMILIES]
_AFTER = re.compile(
    r"(?: as published by the free software foundation(?: inc)?)?"
    r"(?: either)?(?: (?:version|versions|ver|v))?"
    r"(?: (?P<v>[0-9]+(?:\.[0-9]+)*))?(?: of the licen[sc]e)?"
    r"(?P<later> (?:or|and)(?: at your (?:option|choice))?(?: any)? "
    r"(?:later|newer|above|higher|greater)(?: versions?)?)?(?P<only> only)?"
    r"(?: (?:international|unported|generic|universal|public domain dedication"
    r"|style|type|like|public|open source|free software|software|licen[sc]es?"
    r"|version(?! [0-9])))*(?: (?:version|v) (?P<v2>[0-9]+(?:\.[0-9]+)*)"
    r"(?P<later2> or(?: at your option)?(?: any)? later(?: versions?)?)?)?")
_BEFORE = re.compile(
    r"(?:either )?(?:version|v) (?P<v>[0-9]+(?:\.[0-9]+)*)(?P<later> or"
    r"(?: at your option)?(?: any)? later(?: versions?)?)?(?: only)? of the ")
_VERB = ("(?:(?:re|dual |multi |triple )?licen[sc]ed|released|(?:re)?distributed"
         "|made available|made public|available|usable|published|provided"
         "|shared|offered|issued|covered|governed|protected|free software"
         "|open sourced?|free|open source software|subject|placed|put"
         "|(?:released|dedicated|placed) (?:to|in|into) the public domain)")
_HEAD = re.compile(
    r"(?:(?:(?!(?:not|never|no|if|unless|whether|when|cannot|isn) )[^ ]+ )"
    r"{0,10}?(?:(?:is|are|was|were|be|been|being|s) )"
    r"|copyright (?:[^ ]+ ){0,12}?|all rights reserved )?"
    r"(?:(?:also|now|hereby|currently|freely|free|publicly) )*"
    rf"(?:{_VERB}(?:(?: and| or| and or)? {_VERB})*(?: (?:to you|for use|for free"
    r"|freely|as open source|as free software))? )?"
    r"(?:under|by|with|according to|pursuant to|to|on|as|in accordance with)"
    r"(?: and (?:under|by))? ")
_LABEL = re.compile(r"(?:spdx )?licen[sc]es?(?: (?:identifier|information|type))?"
                    r"(?: is| are)? ")
_FILLER = re.compile(
    r"(?:(?:the|a|an|either|both|any|your choice|terms|conditions|term|rules"
    r"|provisions|and conditions|of|one) )+")
_JOIN = re.compile(r" (?:and or|and|or|as well as|at your option|plus)"
                   r"(?: (?:under|at your option|alternatively))?"
                   r"(?= )| with(?= [^ ]+(?: [^ ]+){0,4} exception)")
_REST = re.compile(
    r"(?:| (?:see|https?|www|which|that|as|in|for|found|available|a copy|you|with"
    r"|the licen[sc]e|this licen[sc]e|file|c|copyright|all rights reserved|unless"
    r"|at|by|except|to view|read|please)(?: [^ ]+){0,30})\Z")
_PUBLIC = re.compile(
    r"(?:(?:(?!(?:not|never|no|if|unless|whether|when|cannot) )[^ ]+ ){0,8}?"
    r"(?:is|are|was|were|been|be) )?(?:hereby )?(?:(?:released|dedicated"
    r"|placed|put|made available|published) )?(?:in|into|to) the "
    r"public domain(?: by [^ ]+(?: [^ ]+){0,10})?\Z")
# what says of a work that a licence holds for it, anywhere in a sentence
_GIVEN = ("(?:(?:re|dual |multi |triple )?licen[sc]ed|released"
          "|(?:re)?distributed|made available|made public|available|usable"
          "|published|provided|shared|offered|issued|covered|open sourced?)")
_CORE = re.compile(
    rf"(?<![^ ])(?:{_GIVEN}(?:(?: and| or| and or)? {_GIVEN})*(?: (?:to you"
    r"|for use|for free|freely|as open source|as free software))?"
    r" (?:under|pursuant to|according to|in accordance with)"
    r"(?: and (?:under|by))?|(?:governed|covered|protected) by|subject to) ")
_GIVEN_UP = re.compile(r"(?<![^ ])(?:released|dedicated|placed|put) (?:in|into"
                       r"|to) the public domain(?![^ ])")
_DENIED = re.compile(r"(?<![^ ])(?:not|never|no longer|cannot|isn|aren|without"
                     r"|unless|if|whether|when)(?: [^ ]+){0,2} \Z")
# identifiers a notice shares with the sentences above
_SAME = {"Apache-2.0": "apache2-under", "MPL-2.0": "mpl2-subject"}


def licence_at(words: str, at: int) -> tuple[str, str, int] | None:
    """(family, name, end) of the licence named at ``at``."""
    # "version 3 of the ..."
    first = _BEFORE.match(words, at)
    if first:
        at = first.end()
    for family, pattern in _FAMILY:
        m = pattern.match(words, at)
        if not m:
            continue
        tail = _AFTER.match(words, m.end())
        version = tail["v"] or tail["v2"] or (first and first["v"]) \
            or ONLY.get(family, "")
        later = tail["later"] or tail["later2"] or (first and first["later"])
        if family == "CC":
            # in any order; the word before the first part is no part
            family = "-".join(["CC-BY", *(
                k for k, p in _CC_PARTS if p.search(m.group()))])
        if family in ("MIT", "ISC", "Zlib", "WTFPL", "Unlicense", "0BSD") \
                or family.startswith("BSD"):
            return family, family, tail.end()
        if version and "." not in version:
            version += ".0"
        name = f"{family}-{version}" if version else family
        if version and family in ("GPL", "LGPL", "AGPL", "GFDL"):
            name += "-or-later" if later else "-only"
        return family, name, tail.end()
    return None


def _named(words: str, at: int) -> tuple[list[tuple[str, str, int]], int]:
    """The licences that are named from ``at`` on, joined by "and", "or" and
    the like, and where the last one ends."""
    found, end = [], at
    while True:
        skip = _FILLER.match(words, at)
        got = licence_at(words, at) or (
            licence_at(words, skip.end()) if skip else None)
        if not got:
            return found, end
        found.append(got)
        at = end = got[2]
        j = _JOIN.match(words, at)
        if j:
            at = j.end()
        if words[at:at + 1] != " ":
            return found, end
        at += 1


def _once(found: list[tuple[str, str, int]]) -> list[str]:
    # "... Public License (GPL) version 3" names one licence
    named = {f for f, n, _ in found if n != f}
    return list(dict.fromkeys(n for f, n, _ in found
                              if n != f or f not in named))


def cores(words: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, licences) of every "... licensed under the <name>" in
    normalised words, whatever stands before and behind it, but for a denial
    right before.  A name that is also a common word counts with "licence"
    or a version, or at the end of what is said."""
    out, at = [], 0
    if "licen" not in words and "under" not in words:
        return out
    while m := _CORE.search(words, at):
        at = m.end()
        if _DENIED.search(words, max(0, m.start() - 80), m.start()):
            continue
        found, end = _named(words, m.end())
        if found and ("licen" in words[m.end():end]
                      or any(n != f for f, n, _ in found)
                      or _REST.match(words, end)):
            out.append((m.start(), end, _once(found)))
            at = end
    return out


def notice(words: str) -> list[str]:
    """Licences that a normalised sentence names as those of a work ("... is
    licensed under the <name>"), in order; none if it is no such notice.  A
    family without a version is named without one."""
    if "licen" not in words and "under" not in words:
        if "public domain" not in words:
            return []
    if _PUBLIC.match(words):
        return ["public-domain"]
    for head in (_HEAD, _LABEL):
        m = head.match(words)
        if m:
            found, end = _named(words, m.end())
            if found and _REST.match(words, end):
                return _once(found)
    names = list(dict.fromkeys(n for _, _, names in cores(words)
                               for n in names))
    m = None if names else _GIVEN_UP.search(words)
    if m and not _DENIED.search(words, max(0, m.start() - 80), m.start()):
        return ["public-domain"]
    return names


def normal(sentence: str) -> str:
    """Words and numbers in lower case (A-Z), single blanks between; a + right
    behind a number is "or later"."""
    if "+" in sentence:
        sentence = _PLUS.sub(" or later ", sentence)
    return " ".join(_WORD.findall(sentence.translate(_LOWER)))


def known_id(words: str) -> str | None:
    """Identifier of a normalised sentence that is known as it is, with or
    without a number or letter in front that counts it."""
    if words.count(" ") >= _LONGEST:
        return None
    for w in (words, _NUMBERING.sub("", words)):
        if w in _NORMAL:
            return _NORMAL[w]
        for key, pattern in _OPEN.get(" ".join(w.split(" ", 2)[:2]), ()):
            if pattern.match(w):
                return key
    return None


def _notice_id(names: list[str]) -> str | None:
    if len(names) == 1 and names[0] in _SAME:
        return _SAME[names[0]]
    return _NAMES + " ".join(names) if names else None


def sentence_id(words: str) -> str | None:
    """Identifier of a normalised sentence: a known one, or a notice."""
    return known_id(words) or _notice_id(
        notice(words) or notice(_NUMBERING.sub("", words)))


def _lines(lines: list[tuple[int, int, str]]
           ) -> Iterator[tuple[str | None, int, int]]:
    """(identifier or None, start, end) in the lines (start, end, words) of
    one sentence: runs of lines that are a known sentence, the longest first,
    runs that say a licence holds, and single lines that are a notice."""
    words = " ".join(x[2] for x in lines)
    starts = [0]
    for x in lines:
        starts.append(starts[-1] + len(x[2]) + 1)
    said = {bisect_right(starts, a) - 1: (
        bisect_right(starts, b - 1) - 1, names)
        for a, b, names in reversed(cores(words))}
    i = 0
    while i < len(lines):
        hit = None
        if lines[i][2].split(" ", 1)[0] in _FIRST \
                or _NUMBERING.match(lines[i][2]):
            run, n = [], 0
            for j in range(i, len(lines)):
                run.append(lines[j][2])
                n += lines[j][2].count(" ") + 1
                if n > _LONGEST:
                    break
                if key := known_id(" ".join(run)):
                    hit = key, j
        if not hit and i in said:
            hit = _notice_id(said[i][1]), said[i][0]
        if not hit and (key := _notice_id(notice(lines[i][2]))):
            hit = key, i
        yield (hit[0], lines[i][0], lines[hit[1]][1]) if hit else (
            None, lines[i][0], lines[i][1])
        i = hit[1] + 1 if hit else i + 1


def sentence_ids(text: str | None) -> list[tuple[str | None, int, int]]:
    """(identifier or None, start, end) of the sentences of a text, in
    order.  Sentences end at . ! ? before white space and at empty lines.  A
    sentence of several lines is looked up whole, then by runs of its
    lines.  The time grows with the text's length."""
    out: list[tuple[str | None, int, int]] = []
    for m in _SENTENCE.finditer(text or ""):
        body = m.group()
        lines, at = [], m.start()
        for line in body.split("\n"):
            lines.append((at, at + len(line), normal(line)))
            at += len(line) + 1
        lines = [x for x in lines if x[2]]
        if not lines:
            continue
        if len(lines) == 1:
            out.append((sentence_id(lines[0][2]), m.start(), m.end()))
            continue
        found = list(_lines(lines))
        if all(k is None for k, _, _ in found):
            names = notice(" ".join(x[2] for x in lines))
            if names:
                found = [(_notice_id(names), lines[0][0], lines[-1][1])]
        out += found
    return out


_BY_FIRST: dict[str, list[tuple[str, list[str]]]] = {}
for _name, _seq in sorted(RULES, key=lambda r: -len(r[1].split())):
    _BY_FIRST.setdefault(_seq.split()[0], []).append((_name, _seq.split()))


def licences(text: str | None) -> list[tuple[str, int, int, int]]:
    """(licence, start, end, sentences) of every rule that matches, in text
    order; a sentence is used once, by the longest rule that starts there."""
    marks = sentence_ids(text)
    known = [(k, s, e, i) for i, (k, s, e) in enumerate(marks)
             if k is not None and k != "rights"]
    out, at = [], 0
    while at < len(known):
        if known[at][0].startswith(_NAMES):
            out += [(name, *known[at][1:3], 1)
                    for name in known[at][0][len(_NAMES):].split()]
            at += 1
            continue
        for name, seq in _BY_FIRST.get(known[at][0], ()):
            run = known[at:at + len(seq)]
            if [x[0] for x in run] == seq and all(
                    b[3] - a[3] <= BETWEEN + 1
                    for a, b in zip(run, run[1:])):
                out.append((name, run[0][1], run[-1][2], len(seq)))
                at += len(seq)
                break
        else:
            at += 1
    return out


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, licences (names,
    each once, sorted) and matches (licence, start, end: code points of the
    text, sentences: how many the rule has), in text order.

    Null, empty and licence-free texts give empty arrays; repeated rows are
    scanned each; an empty table gives no rows; other columns are ignored.
    One pass, no shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ("licence", "start", "end", "sentences")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = pa.list_(pa.struct([("licence", pa.string()),
                                    ("start", pa.int64()), ("end", pa.int64()),
                                    ("sentences", pa.int32())]))
        for b in batches:
            found = [licences(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"),
                 pa.array([sorted({x[0] for x in f}) for f in found],
                          pa.list_(pa.string())),
                 pa.array([[dict(zip(names, x)) for x in f] for f in found],
                          match)], ["doc_id", "licences", "matches"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, licences array<string>, matches array<struct<"
        "licence: string, start: long, end: long, sentences: int>>")


def op6_query(docs: DataFrame) -> DataFrame:
    return scan(docs)
