"""Signature rules for licence notices: (label, priority, keyword, pattern).

Patterns are matched against a text's words, lower case and with single blanks between them; a
keyword is a string without which the pattern cannot match. Rules stand in order of precedence
within a priority. The lines are written by hand; families that differ only by licence elements and
versions are spelled out from their parts below.
"""

from __future__ import annotations

# priority 3: wording of a licence or a grant; 2: a notice; 1: a mere name.
_LINES = r"""
mit | 3 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 3 | mit license | (?:under|with) the(?: terms of the)? mit license
mit | 2 | mit license | the mit license(?: mit)?
mit | 2 | mit license | (?:released|licensed|distributed|available) under the mit license
mit | 2 | mit | spdx license identifier mit
mit | 2 | mit | licen[sc]ed? mit
mit | 1 | mit license | mit license
mit | 2 | expat | (?:under the )?expat licen[sc]e
mit-0 | 3 | mit | mit no attribution
mit-0 | 3 | mit 0 | spdx license identifier mit 0
x11 | 2 | x11 | (?:the )?x11 licen[sc]e
isc | 3 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 2 | isc | (?:under the |the )?isc licen[sc]e
isc | 2 | isc | spdx license identifier isc
0bsd | 3 | 0bsd | spdx license identifier 0bsd
0bsd | 2 | zero clause bsd | (?:bsd )?zero clause bsd(?: license)?
apache-2 | 3 | apache | licensed under the apache license version 2 0(?: the license)?
apache-2 | 3 | apache | you may not use this file except in compliance with the license you may obtain a copy of the license at(?: https?)? www apache org licenses license 2 0
apache-2 | 2 | apache | apache license version 2(?: 0)?
apache-2 | 2 | apache | apache license 2(?: 0)?
apache-2 | 2 | apache | spdx license identifier apache 2 0
apache-2 | 2 | apache | apache 2(?: 0)? license
apache-2 | 2 | apache | www apache org licenses license 2 0
apache-2 | 1 | apache | apache software license version 2(?: 0)?
apache-1.1 | 2 | apache | apache software license version 1 1
apache-1.0 | 2 | apache | apache (?:software )?license version 1 0
apache | 1 | apache | apache (?:software )?license
bsd-2-clause | 3 | bsd 2 | spdx license identifier bsd 2 clause
bsd-2-clause | 2 | bsd | (?:simplified|freebsd) bsd licen[sc]e
bsd-2-clause | 2 | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[sc]e)?
bsd-3-clause | 3 | neither the name of | neither the name of (?:\S+ ){1,12}?nor the names of its contributors may be used to endorse or promote products
bsd-3-clause | 3 | bsd 3 | spdx license identifier bsd 3 clause
bsd-3-clause | 2 | bsd | (?:new|modified|revised) bsd licen[sc]e
bsd-3-clause | 2 | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[sc]e)?
bsd-4-clause | 3 | all advertising materials | all advertising materials mentioning features or use of this software must display
bsd-4-clause | 2 | bsd | (?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[sc]e)?
bsd | 2 | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd | 2 | bsd | (?:under|with) (?:the|a)(?: terms of the)? bsd(?: style)? licen[sc]e
bsd | 1 | bsd | bsd(?: style)? licen[sc]e
mpl-2.0 | 3 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 2 | mozilla | mozilla public license (?:version |v ?)?2(?: 0)?
mpl-2.0 | 2 | mpl | spdx license identifier mpl 2 0
mpl-2.0 | 1 | mpl | mpl (?:v ?)?2 0
mpl-1.1 | 2 | mozilla | mozilla public license (?:version |v ?)?1 1
mpl-1.1 | 2 | mpl | spdx license identifier mpl 1 1
mpl | 1 | mozilla | mozilla public license
epl-2.0 | 3 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license v ?2 0
epl-2.0 | 2 | eclipse | eclipse public license (?:version |v ?)?2(?: 0)?
epl-2.0 | 2 | epl | spdx license identifier epl 2 0
epl-1.0 | 2 | eclipse | eclipse public license (?:version |v ?)?1(?: 0)?
epl-1.0 | 2 | epl | spdx license identifier epl 1 0
epl | 1 | eclipse | eclipse public license
edl-1.0 | 2 | eclipse | eclipse distribution license (?:version |v ?)?1(?: 0)?
cddl-1.0 | 2 | cddl | spdx license identifier cddl 1 0
cddl-1.1 | 2 | cddl | spdx license identifier cddl 1 1
cddl | 2 | common development and distribution | common development and distribution license
cpl-1.0 | 2 | common public license | common public license (?:version |v ?)?1 0
eupl-1.2 | 2 | european union public | european union public licen[sc]e (?:version |v ?)?1 2
eupl-1.2 | 2 | eupl | (?:spdx license identifier )?eupl 1 2
eupl-1.1 | 2 | european union public | european union public licen[sc]e (?:version |v ?)?1 1
eupl | 1 | european union public | european union public licen[sc]e
artistic-2.0 | 2 | artistic | artistic license (?:version |v ?)?2(?: 0)?
artistic-1.0 | 2 | artistic | artistic license (?:version |v ?)?1(?: 0)?
artistic | 1 | artistic | artistic licen[sc]e
perl | 2 | the same terms as perl | (?:under )?the same terms as perl(?: 5)? itself
zlib | 3 | express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | 2 | zlib | (?:the )?zlib(?: libpng)? licen[sc]e
zlib | 2 | zlib | spdx license identifier zlib
libpng | 2 | libpng | (?:the )?libpng licen[sc]e
boost-1.0 | 3 | boost | distributed under the boost software license version 1 0
boost-1.0 | 2 | boost | boost software license(?: version 1(?: 0)?)?
boost-1.0 | 2 | bsl 1 | spdx license identifier bsl 1 0
unlicense | 3 | public domain | this is free and unencumbered software released into the public domain
unlicense | 2 | unlicense | (?:the unlicense|spdx license identifier unlicense|unlicense org)
wtfpl | 3 | do what the | do what the fuck you want to public license
wtfpl | 2 | wtfpl | (?:the )?wtfpl
public-domain | 2 | public domain | (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain | 1 | public domain | public domain(?: dedication)?
cc0-1.0 | 3 | cc0 | spdx license identifier cc0 1 0
cc0-1.0 | 2 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 2 | creativecommons | creativecommons org publicdomain zero 1 0
cc0-1.0 | 2 | creative commons zero | creative commons zero(?: v?1 0)?(?: universal)?
cc-pdm | 2 | creativecommons | creativecommons org publicdomain mark 1 0
cc | 1 | creative commons | (?:a |the )?creative commons(?: public)? licen[sc]e
odbl-1.0 | 2 | open database license | open (?:data commons )?open database license|open database license
odc-by-1.0 | 2 | open data commons | open data commons attribution license
pddl-1.0 | 2 | open data commons | open data commons public domain dedication(?: and license)?
ogl-3.0 | 2 | open government | open government licen[sc]e (?:version |v ?)?3(?: 0)?
ogl | 1 | open government | open government licen[sc]e
gfdl-1.3 | 2 | free documentation | (?:gnu )?free documentation license version 1 3
gfdl-1.2 | 2 | free documentation | (?:gnu )?free documentation license version 1 2
gfdl | 1 | free documentation | (?:gnu )?free documentation licen[sc]e
psf-2.0 | 2 | python software foundation | python software foundation license(?: version 2)?
python-2.0 | 2 | python license | (?:the )?python license(?: 2 0)?
php-3.01 | 2 | php license | (?:the )?php license (?:version |v ?)?3 01
ruby | 2 | ruby license | (?:the )?ruby license
openssl | 2 | openssl | openssl licen[sc]e
w3c | 2 | w3c | w3c software(?: notice and)? licen[sc]e
ofl-1.1 | 3 | open font license | this font software is licensed under the sil open font license version 1 1
ofl-1.1 | 2 | open font license | (?:sil )?open font license(?: version)?(?: 1 1)?
ms-pl | 2 | microsoft public | microsoft public license(?: ms pl)?
ms-rl | 2 | microsoft reciprocal | microsoft reciprocal license(?: ms rl)?
sspl-1.0 | 2 | server side public | server side public license(?: version 1)?
busl-1.1 | 2 | business source | business source license(?: version)?(?: 1 1)?
elastic-2.0 | 2 | elastic license | elastic license(?: 2 0)?
commons-clause | 2 | commons clause | (?:the )?commons clause(?: license)?(?: condition)?
polyform-nc | 2 | polyform | polyform noncommercial license(?: 1 0 0)?
openrail | 2 | openrail | (?:creativeml |bigscience )?openrail(?: m| m)?(?: license)?
afl-3.0 | 2 | academic free | academic free license (?:version |v ?)?3 0
osl-3.0 | 2 | open software license | open software license (?:version |v ?)?3 0
cecill-2.1 | 2 | cecill | cecill(?: free software license agreement)?(?: version)?(?: 2 1)?
bsl-ijg | 2 | independent jpeg group | (?:based in part on )?the work of the independent jpeg group
unicode | 2 | unicode | unicode (?:inc )?license agreement
vim | 2 | vim license | (?:the )?vim license
beerware | 3 | beer | the beer ?ware license
json | 3 | good not evil | the software shall be used for good not evil
proprietary | 2 | all rights reserved | all rights reserved
proprietary | 2 | proprietary | proprietary and confidential
proprietary | 2 | unauthorized copying | unauthorized copying of this file via any medium is strictly prohibited
proprietary | 2 | express written permission | (?:without|with) (?:the )?(?:prior )?express written permission
proprietary | 1 | internal use only | for internal use only
copyright | 1 | copyright | copyright (?:c )?(?:19|20)\d\d
"""


def _creative_commons() -> list[tuple[str, int, str, str]]:
    """Six licences, in each version and without one: address, long name, short name."""
    long = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
    rules = []
    for parts in (["by"], ["by", "sa"], ["by", "nd"], ["by", "nc"], ["by", "nc", "sa"], ["by", "nc", "nd"]):
        short, name = " ".join(parts), " ".join(long[p] for p in parts)
        label = "cc-" + "-".join(parts)
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0", ""):
            number = version.replace(".", " ")
            exact, tail = (f"{label}-{version}", f" {number}") if version else (label, "")
            more = (f" (?:{number}|version {number})(?: (?:international|unported|generic))?") if version else ""
            rules.append((exact, 3, "creativecommons", f"creativecommons org licenses {short}{tail}"))
            rules.append((exact, 2, "creative commons", f"creative commons {name}{more}(?: licen[sc]e)?"))
            rules.append((exact, 2, f"cc {short}", f"(?:licensed under |spdx license identifier )?cc {short}{tail}"))
    return rules


def _gnu() -> list[tuple[str, int, str, str]]:
    """Three licences, in each version and without one: notice with and without "or later", long name, short name."""
    rules = []
    for label, name, versions in (
        ("gpl", "general public", ("1.0", "2.0", "3.0")),
        ("lgpl", "(?:lesser|library) general public", ("2.0", "2.1", "3.0")),
        ("agpl", "affero general public", ("1.0", "3.0")),
    ):
        key = name.rpartition(") ")[2]
        for version in versions:
            major, minor = version.split(".")
            number = major + (f" {minor}" if minor != "0" else "(?: 0)?")
            base = f"{label}-{version}"
            rules += [
                (f"{base}-or-later", 3, key, f"(?:gnu )?{name} license (?:version |v ?)?{number} or (?:any later|later|at your option any later)(?: version)?"),
                (f"{base}-or-later", 3, key, f"(?:gnu )?{name} license as published by the free software foundation either version {number} of the license or"),
                (f"{base}-or-later", 3, label, f"spdx license identifier {label} {major} {minor} or later"),
                (f"{base}-only", 3, label, f"spdx license identifier {label} {major} {minor}(?: only)?"),
                (base, 2, key, f"(?:gnu )?{name} license (?:version |v ?)?{number}"),
                (base, 2, label, f"{label} ?v?{number}"),
            ]
        rules.append((label, 1, key, f"(?:gnu )?{name} licen[sc]e"))
        rules.append((label, 1, label, f"gnu {label}"))
    return rules


def rules() -> list[tuple[str, int, str, str]]:
    """All rules in order of precedence: priority first, then as written."""
    written = [tuple(p.strip() for p in line.split(" | ")) for line in _LINES.strip().splitlines()]
    every = [(label, int(rank), key, pattern) for label, rank, key, pattern in written] + _creative_commons() + _gnu()
    return sorted(every, key=lambda r: -r[1])
