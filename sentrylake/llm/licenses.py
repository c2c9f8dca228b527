"""License scans by ordered signature rules.

Rules are regular expressions over a text's lower-cased words (joined by single blanks), each gated by
keywords, one for each of its alternatives: one Aho-Corasick pass over the text gives the keywords that
occur, and only rules with one of them run. Overlapping detections are settled by priority: in order of priority, then length, then
place, a detection stands unless a standing one contains its words; what lies inside a standing
detection is suppressed. Base rules are never suppressed.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import ahocorasick
import numpy as np


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[str, ...]  # every match holds one of them
    pattern: re.Pattern
    base: bool = False


class Hit(NamedTuple):
    label: str
    priority: int
    first: int  # words from 0
    last: int  # the word after
    base: bool


#: The phrases that always count, with their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# label | priority | keyword | expression over lower-cased words. Alternatives without the keyword get one of their own words (gates). Full texts come before notices, notices before
# tags and tags before bare names; a higher priority wins.
_RULES = r"""
spdx-tag                | 90 | spdx        | spdx license identifier [0-9a-z]+(?: [0-9]+)*
mit-text                | 80 | permission  | permission is hereby granted free of charge to any person obtaining a copy of this software
mit-conditions          | 70 | permission  | the above copyright notice and this permission notice shall be included in all copies
mit-warranty            | 60 | merchantability | the software is provided as is without warranty of any kind express or implied
mit-0                   | 55 | attribution | mit no attribution|mit 0 license
mit-x11                 | 55 | x11         | x11 license|mit x11|x consortium
mit-expat               | 55 | expat       | expat license
isc-text                | 80 | permission  | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc                     | 50 | isc         | isc license
0bsd                    | 55 | 0bsd        | 0bsd|zero clause bsd
bsd-text                | 80 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-endorse             | 70 | endorse     | neither the names? of .{1,80}? nor the names of its contributors may be used to endorse
bsd-advertising         | 75 | advertising | all advertising materials mentioning features or use of this software must display
bsd-1                   | 56 | bsd         | bsd 1 clause|1 clause bsd
bsd-2                   | 56 | bsd         | bsd 2 clause|2 clause bsd|simplified bsd|freebsd license
bsd-3                   | 56 | bsd         | bsd 3 clause|3 clause bsd|new bsd license|modified bsd license|revised bsd
bsd-4                   | 56 | bsd         | bsd 4 clause|4 clause bsd|original bsd license
bsd-patent              | 57 | patent      | bsd 2 clause plus patent|bsd patent license
bsd                     | 40 | bsd         | bsd license|bsd style license
apache-notice           | 78 | apache      | licensed under the apache license version 2 0 the license you may not use this file except in compliance
apache-header           | 60 | apache      | licensed under the apache license
apache-2                | 56 | apache      | apache license version 2 0|apache 2 0|apache license 2 0|asl 2 0
apache-1.1              | 57 | apache      | apache software license version 1 1|apache 1 1
apache-1                | 57 | apache      | apache license version 1 0|apache 1 0
gpl-notice              | 78 | gnu         | redistribute it and or modify it under the terms of the gnu (?:lesser |library |affero )?general public license
gpl-warranty            | 65 | gnu         | see the gnu (?:lesser |library |affero )?general public license for more details
gpl-receipt             | 66 | gnu         | you should have received a copy of the gnu (?:lesser |library |affero )?general public license
gpl-exception-classpath | 72 | classpath   | classpath exception
gpl-exception-gcc       | 72 | runtime     | gcc runtime library exception
gpl-exception-bison     | 72 | bison       | bison exception
gpl-exception-font      | 72 | font        | font exception
gpl-exception-linking   | 72 | linking     | linking exception
gpl-exception-autoconf  | 72 | autoconf    | autoconf (?:configure )?exception
gfdl-notice             | 78 | documentation | terms of the gnu free documentation license
gfdl                    | 50 | documentation | gnu free documentation license|free documentation license
lgpl-linux              | 58 | lgpl        | lgpl linux linking
mpl-notice              | 78 | mozilla     | subject to the terms of the mozilla public license
mpl-incompatible        | 70 | secondary   | incompatible with secondary licenses
epl-notice              | 78 | eclipse     | made available under the terms of the eclipse public license
edl                     | 50 | eclipse     | eclipse distribution license
cddl-notice             | 78 | common      | subject to the terms of the common development and distribution license
boost-text              | 80 | boost       | distributed under the boost software license
boost                   | 50 | boost       | boost software license|bsl 1 0
zlib-text               | 80 | misrepresented | the origin of this software must not be misrepresented
zlib-altered            | 75 | altered     | altered source versions must be plainly marked as such
zlib                    | 45 | zlib        | zlib license|zlib libpng license
libpng                  | 50 | libpng      | libpng license|png reference library license
unlicense-text          | 80 | unencumbered | this is free and unencumbered software released into the public domain
unlicense               | 45 | unlicense   | the unlicense|unlicense org
wtfpl                   | 50 | wtfpl       | wtfpl|do what the fuck you want to public license
public-domain           | 35 | domain      | public domain dedication|placed in the public domain|released into the public domain|dedicated to the public domain
cc0-text                | 80 | cc0         | cc0 1 0 universal|creative commons zero
pddl                    | 50 | pddl        | open data commons public domain dedication|pddl
odbl                    | 50 | database    | open database license|odc odbl
odc-by                  | 50 | odc         | open data commons attribution license|odc by
dbcl                    | 50 | database    | database contents license
python-2                | 55 | python      | python software foundation license|psf license agreement|python license 2 0
cnri-python             | 55 | cnri        | cnri open source license|cnri python license
ruby                    | 45 | ruby        | ruby license|ruby s license
php-3                   | 55 | php         | php license version 3 0 1|php license version 3 01|php license
zend                    | 50 | zend        | zend engine license|zend license
perl-terms              | 60 | perl        | under the same terms as perl itself
artistic-clarified      | 56 | artistic    | clarified artistic license
artistic-2              | 56 | artistic    | artistic license 2 0|artistic license version 2
artistic                | 45 | artistic    | artistic license
ms-pl                   | 50 | microsoft   | microsoft public license
ms-rl                   | 50 | microsoft   | microsoft reciprocal license
ms-lpl                  | 50 | microsoft   | microsoft limited public license
osl                     | 50 | open        | open software license
afl                     | 50 | academic    | academic free license
ecl                     | 50 | educational | educational community license
nposl                   | 50 | profit      | non profit open software license
cpl                     | 50 | common      | common public license
ipl                     | 50 | ibm         | ibm public license
lpl                     | 50 | lucent      | lucent public license
sun-industry            | 50 | sun         | sun industry standards source license
sun-public              | 50 | sun         | sun public license
npl                     | 50 | netscape    | netscape public license
nokia                   | 50 | nokia       | nokia open source license
qpl                     | 50 | public      | q public license
rpl                     | 50 | reciprocal  | reciprocal public license
rpsl                    | 50 | realnetworks | realnetworks public source license
apsl                    | 50 | apple       | apple public source license
apple-mit               | 50 | apple       | apple mit license
intel                   | 50 | intel       | intel open source license
hpnd                    | 50 | permission  | historical permission notice and disclaimer
ntp-text                | 60 | permission  | permission to use copy modify and distribute this software and its documentation for any purpose
curl                    | 50 | curl        | curl license
openssl                 | 50 | openssl     | openssl license
ssleay                  | 50 | ssleay      | ssleay license|original ssleay
openldap                | 50 | openldap    | openldap public license
postgresql              | 50 | postgresql  | postgresql license
sqlite-blessing         | 60 | blessing    | in place of a legal notice here is a blessing
vim                     | 50 | vim         | vim license
vim-charity             | 60 | vim         | vim is charityware
tcl                     | 50 | tcl         | tcl tk license|tcl license
unicode                 | 50 | unicode     | unicode (?:inc )?license agreement|unicode license
icu                     | 50 | icu         | icu license
w3c                     | 50 | w3c         | w3c software notice and (?:document )?license|w3c license
ncsa                    | 50 | illinois    | university of illinois ncsa open source license
upl                     | 50 | universal   | universal permissive license
eupl                    | 50 | european    | european union public licen[cs]e
cecill                  | 50 | cecill      | cecill(?: [bc])?(?: license)?
mulan-psl               | 50 | mulan       | mulan permissive software license
mulan-publ              | 50 | mulan       | mulan public license
blueoak                 | 50 | oak         | blue oak model license
ofl                     | 50 | font        | sil open font license|open font license
bitstream-vera          | 50 | bitstream   | bitstream vera (?:fonts )?(?:copyright|license)
ubuntu-font             | 50 | ubuntu      | ubuntu font licen[cs]e
ipa-font                | 50 | ipa         | ipa font license
latex-lppl              | 50 | latex       | latex project public license
knuth                   | 50 | knuth       | knuth ctan license
info-zip                | 50 | zip         | info zip license
bzip2                   | 50 | bzip2       | bzip2 license|bzip2 and libbzip2 license
ijg                     | 50 | jpeg        | independent jpeg group
libtiff                 | 50 | libtiff     | libtiff license
imagemagick             | 50 | imagemagick | imagemagick license
gnuplot                 | 50 | gnuplot     | gnuplot license
beerware                | 50 | beer        | beer ?ware license|buy me a beer in return
json-evil               | 60 | evil        | the software shall be used for good not evil
ansible-community       | 40 | community   | community license agreement
elastic                 | 50 | elastic     | elastic license(?: 2 0| v2)?
sspl                    | 50 | server      | server side public license
busl                    | 50 | business    | business source license
commons-clause          | 55 | commons     | commons clause
confluent               | 50 | confluent   | confluent community license
redis-sal               | 50 | redis       | redis source available license
timescale               | 50 | timescale   | timescale license
polyform                | 50 | polyform    | polyform (?:noncommercial|small business|strict|shield|internal use|free trial|perimeter) license
prosperity              | 50 | prosperity  | prosperity public license
parity                  | 50 | parity      | parity public license
openrail                | 50 | rail        | open ?rail(?: m)?(?: license)?
bigscience-rail         | 55 | bigscience  | bigscience (?:open )?rail license
llama-community         | 55 | llama       | llama [0-9] (?:[0-9] )?community license
gemma-terms             | 55 | gemma       | gemma terms of use
deepseek                | 50 | deepseek    | deepseek license
proprietary             | 35 | proprietary | proprietary and confidential|proprietary license
all-rights-reserved     | 20 | reserved    | all rights reserved
eula                    | 35 | end         | end user license agreement
non-commercial          | 35 | commercial  | for non ?commercial (?:use|purposes) only
research-only           | 35 | research    | for (?:academic )?research (?:use|purposes) only
no-derivatives          | 35 | derivative  | no derivative works
copyright-notice        | 15 | copyright   | copyright (?:c )?(?:19|20)[0-9][0-9]
license-file            | 25 | license     | see (?:the )?(?:file )?license(?: file)? for (?:details|more information|license information)
license-terms           | 22 | licensed    | licensed under the terms of
dual-license            | 45 | dual        | dual licensed under|dual license
mit-or-apache           | 58 | apache      | mit or apache(?: license)?(?: version)? 2 0|apache 2 0 or mit|mit apache 2 0
"""


def _versions(label: str, priority: int, keyword: str, name: str, versions: str) -> list[str]:
    """A rule for each version of a family, and one for later ones where the family allows that."""
    out = []
    for v in versions.split():
        spoken = v.replace(".", " ").removesuffix(" 0")
        tail = f"(?:version |v ?){spoken}(?: 0)?(?! [1-9])"
        out.append(f"{label}-{v} | {priority} | {keyword} | {name} {tail}")
        out.append(f"{label}-{v}-or-later | {priority + 2} | {keyword} | {name} {tail} or (?:\\(?at your option\\)? ?any )?later")
        out.append(f"{label}-{v}-only | {priority + 2} | {keyword} | {name} {tail} only")
    return out


def _creative_commons() -> list[str]:
    """Every kind of Creative Commons attribution licence in each version, long and short names."""
    kinds = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s?", "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike", "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?"}
    out = []
    for kind, name in kinds.items():
        short = kind.replace("-", " ")
        rank = 50 + len(kind)
        out.append(f"cc-{kind} | {rank} | creative | creative commons {name}(?! (?:share|non|no))")
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            out.append(f"cc-{kind}-{v} | {rank + 10} | cc | cc {short} {v.replace('.', ' ')}")
    return out


#: Words that many texts hold; they gate an alternative only where it has no other.
_FREQUENT = {"license", "agreement", "public", "open", "source", "software", "what", "the", "you", "want"}


def _alternatives(pattern: str) -> list[str]:
    """The parts between the bars outside of all brackets."""
    out, depth = [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def gates(pattern: str, keyword: str) -> tuple[str, ...]:
    """A keyword for each alternative of the pattern: the given one where each match holds it, else one of the words that each match holds."""
    out = []
    for part in _alternatives(re.sub(r"\\.\??", "\0", pattern)):
        sure = part
        while "(" in sure:
            sure = re.sub(r"\([^()]*\)\??", "\0", sure)
        sure = re.sub(r"\[[^]]*\]|\{[^}]*\}|.\?", "\0", sure)
        words = re.findall("[0-9a-z]+", sure)
        if any(keyword in w for w in words):
            out.append(keyword)
        else:
            out.append(min(words, key=lambda w: (w in _FREQUENT, -len(w), w)))
    return tuple(dict.fromkeys(out))


def rules() -> list[Rule]:
    """All rules in order of priority."""
    lines = [x for x in _RULES.splitlines() if x.strip()]
    lines += _versions("gpl", 60, "general", "gnu general public license", "1 2 3") + _versions("lgpl", 62, "general", "gnu (?:lesser|library) general public license", "2 2.1 3") + _versions("agpl", 62, "affero", "gnu affero general public license", "1 3") + _versions("mpl", 60, "mozilla", "mozilla public license", "1.0 1.1 2.0") + _versions("epl", 60, "eclipse", "eclipse public license", "1.0 2.0") + _versions("cddl", 60, "common", "common development and distribution license", "1.0 1.1") + _versions("osl-v", 60, "open", "open software license", "1.0 2.0 2.1 3.0") + _versions("afl-v", 60, "academic", "academic free license", "1.1 1.2 2.0 2.1 3.0") + _creative_commons()
    out = [Rule(label, 100, (phrase.split()[0],), re.compile(rf"\b{phrase}\b"), True) for phrase, label in BASE_PHRASES]
    for line in lines:
        label, priority, keyword, pattern = (x.strip() for x in line.split("|", 3))
        out.append(Rule(label, int(priority), gates(pattern, keyword), re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")))
    return sorted(out, key=lambda r: -r.priority)


_IS_WORD = np.zeros(256, bool)
_IS_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_IS_WORD[128:] = True  # bytes of characters beyond ASCII


class LicenseScanner:
    def __init__(self, known: list[Rule] | None = None):
        self.rules = known if known is not None else rules()
        by: dict[str, list[int]] = {}
        for k, r in enumerate(self.rules):
            for word in r.keywords:
                by.setdefault(word, []).append(k)
        self.keywords = ahocorasick.Automaton()
        for word, ks in by.items():
            self.keywords.add_word(word, tuple(ks))
        self.keywords.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[Hit]]:
        """The number of words and the standing detections, in order of place.

        Null texts count as empty, and those have neither words nor detections. Texts are read whole, whatever their length. Equal
        texts have equal detections; of equal detections of one priority the one whose label comes first stands.
        """
        raw = (text or "").encode("utf-8", "replace").lower()  # of bytes, only A to Z are changed
        word = _IS_WORD[np.frombuffer(raw, np.uint8)]
        n_words = int(word[:1].sum()) + int(np.count_nonzero(word[1:] > word[:-1]))
        low = raw.decode("latin-1")
        wanted: set[int] = set()
        for _, ks in self.keywords.iter(low):
            wanted.update(ks)
        if not wanted:
            return n_words, []
        plain = " ".join(re.findall("[0-9a-z\x80-\xff]+", low))
        spaces = np.flatnonzero(np.frombuffer(plain.encode("latin-1"), np.uint8) == 32)
        hits = []
        for k in wanted:
            r = self.rules[k]
            for m in r.pattern.finditer(plain):
                if r.base and ((m.start() and plain[m.start() - 1] != " ") or (m.end() < len(plain) and plain[m.end()] != " ")):
                    continue
                first = int(np.searchsorted(spaces, m.start()))
                hits.append(Hit(r.label, r.priority, first, first + m[0].count(" ") + 1, r.base))
        return n_words, self.settle(hits)

    @staticmethod
    def settle(hits: list[Hit]) -> list[Hit]:
        """Drops each detection whose words lie inside a standing one of at least its priority; base ones stay and suppress none."""
        standing: list[Hit] = []
        starts: list[int] = []  # of a chain of standing detections, none of which contains another
        ends: list[int] = []
        for h in sorted((h for h in hits if not h.base), key=lambda h: (-h.priority, h.first - h.last, h.first, h.label)):
            k = int(np.searchsorted(starts, h.first, side="right"))
            if k and max(ends[:k][-1:]) >= h.last:
                continue
            standing.append(h)
            # Keep starts and ends both ascending: what the new detection contains can suppress nothing that it doesn't.
            lo = int(np.searchsorted(starts, h.first))
            hi = lo
            while hi < len(ends) and ends[hi] <= h.last:
                hi += 1
            starts[lo:hi], ends[lo:hi] = [h.first], [h.last]
        standing += [h for h in hits if h.base]
        return sorted(standing, key=lambda h: (h.first, h.last, h.label))


def confidence(n_words: int, hits: list[Hit]) -> float:
    """0 without a detection, else nearer 1 the higher the priorities and the larger the part of the text that they cover."""
    if not hits:
        return 0.0
    best = max(h.priority for h in hits) / 100
    covered = min(1.0, sum(h.last - h.first for h in hits) / max(1, n_words))
    return round(min(1.0, 0.75 * best + 0.25 * covered), 6)
