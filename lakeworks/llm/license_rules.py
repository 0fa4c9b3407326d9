"""Signature rules of the license scan, written for normalised text: lower-case words with single blanks.

Each line is: label | priority | keyword | regex. The keyword is a plain string that every match contains; it gates the
regex. The higher priority wins where detections overlap. Versions read "2 0", as punctuation separates words.
"""

from __future__ import annotations

HAND_WRITTEN = r"""
apache-2.0 | 90 | apache | (?:licensed under the )?apache license (?:version )?2(?: 0)?
apache-2.0 | 80 | apache | apache 2 0(?: license)?
apache-2.0 | 70 | apache org licenses | www apache org licenses license 2 0
apache-1.1 | 90 | apache | apache (?:software )?license (?:version )?1 1
apache-1.0 | 90 | apache | apache (?:software )?license (?:version )?1 0
apache | 40 | apache | (?:licensed under the )?apache (?:software )?license
apache | 30 | apache | apache licensed
mit | 90 | mit license | (?:released|licensed|distributed|available) under the (?:terms of the )?mit license
mit | 80 | mit license | (?:the )?mit license(?: mit)?
mit | 60 | mit licensed | mit licensed
mit | 70 | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy
mit | 60 | the software is provided as is | the software is provided as is without warranty of any kind
mit-0 | 90 | mit no attribution | mit no attribution(?: license)?
x11 | 80 | x11 license | x11 license
expat | 80 | expat license | expat license
bsd-3-clause | 90 | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?
bsd-2-clause | 90 | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?
bsd-4-clause | 90 | bsd | (?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?
bsd-0-clause | 90 | bsd | (?:0bsd|bsd zero clause|zero clause bsd)(?: license)?
bsd | 50 | bsd | bsd (?:style )?licen[cs]ed?
bsd | 60 | redistribution and use in source | redistribution and use in source and binary forms
bsd-3-clause | 65 | may be used to endorse | may be used to endorse or promote products derived from
isc | 90 | isc license | isc license
isc | 70 | permission to use copy modify | permission to use copy modify and or distribute this software
ncsa | 80 | ncsa | university of illinois ncsa open source license
zlib | 80 | zlib | zlib(?: libpng)? license
libpng | 80 | libpng | libpng license
curl | 80 | curl license | curl license
openssl | 80 | openssl license | openssl license
python-2.0 | 80 | python | python (?:software foundation )?license(?: version)? 2(?: 0)?
psf | 70 | python software foundation | python software foundation license
php-3.01 | 80 | php license | php license (?:version )?3 01
php | 50 | php license | php license
ruby | 60 | ruby license | ruby license
perl-artistic-1.0 | 80 | artistic license | artistic license 1 0
perl-artistic-2.0 | 80 | artistic license | artistic license 2 0
perl-artistic | 50 | artistic license | artistic license
mpl-1.0 | 90 | mozilla public license | mozilla public license (?:version |v )?1 0
mpl-1.1 | 90 | mozilla public license | mozilla public license (?:version |v )?1 1
mpl-2.0 | 90 | mozilla public license | mozilla public license (?:version |v )?2 0
mpl | 50 | mozilla public license | mozilla public license
mpl-2.0 | 70 | mpl | mpl 2 0
epl-1.0 | 90 | eclipse public license | eclipse public license (?:version |v )?1 0
epl-2.0 | 90 | eclipse public license | eclipse public license (?:version |v )?2 0
epl | 50 | eclipse public license | eclipse public license
edl-1.0 | 80 | eclipse distribution license | eclipse distribution license(?: v? ?1 0)?
cpl-1.0 | 80 | common public license | common public license(?: version)?(?: 1 0)?
ipl-1.0 | 80 | ibm public license | ibm public license(?: version)?(?: 1 0)?
cddl-1.0 | 90 | common development and distribution | common development and distribution license (?:version )?1 0
cddl-1.1 | 90 | common development and distribution | common development and distribution license (?:version )?1 1
cddl | 50 | common development and distribution | common development and distribution license
cpal-1.0 | 80 | common public attribution | common public attribution license(?: version)?(?: 1 0)?
eupl-1.1 | 90 | european union public | european union public licen[cs]e (?:version |v )?1 1
eupl-1.2 | 90 | european union public | european union public licen[cs]e (?:version |v )?1 2
eupl | 50 | european union public | european union public licen[cs]e
cecill-2.1 | 80 | cecill | cecill (?:free software license agreement )?(?:version |v )?2 1
cecill-b | 80 | cecill | cecill b
cecill-c | 80 | cecill | cecill c
cecill | 40 | cecill | cecill
osl-3.0 | 80 | open software license | open software license (?:version |v )?3 0
osl | 50 | open software license | open software license
afl-3.0 | 80 | academic free license | academic free license (?:version |v )?3 0
afl | 50 | academic free license | academic free license
ms-pl | 80 | microsoft public license | microsoft public license(?: ms pl)?
ms-rl | 80 | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
bsl-1.0 | 90 | boost software license | boost software license(?: version)?(?: 1 0)?
busl-1.1 | 90 | business source license | business source license(?: version)?(?: 1 1)?
sspl-1.0 | 90 | server side public license | server side public license(?: version)?(?: 1)?
elastic-2.0 | 90 | elastic license | elastic license(?: version)? 2 0
elastic | 50 | elastic license | elastic license
unlicense | 90 | unlicense | (?:the )?unlicense
unlicense | 70 | free and unencumbered software | this is free and unencumbered software released into the public domain
wtfpl | 80 | wtfpl | wtfpl
zpl-2.1 | 80 | zope public license | zope public license(?: version)? 2 1
zpl | 50 | zope public license | zope public license
postgresql | 80 | postgresql license | postgresql license
mulan-psl-2.0 | 80 | mulan | mulan (?:psl|permissive software license) v?2
upl-1.0 | 80 | universal permissive license | universal permissive license(?: v? ?1 0)?
ncl | 50 | non commercial license | non commercial license
sil-ofl-1.1 | 90 | open font license | (?:sil )?open font license (?:version )?1 1
sil-ofl | 60 | open font license | (?:sil )?open font license
ubuntu-font | 80 | ubuntu font licen | ubuntu font licen[cs]e
bitstream-vera | 80 | bitstream vera | bitstream vera(?: fonts)? (?:license|copyright)
odbl-1.0 | 90 | open database license | (?:open data commons )?open database license(?: odbl)?(?: v? ?1 0)?
odc-by-1.0 | 90 | open data commons | open data commons attribution license(?: v? ?1 0)?
pddl-1.0 | 90 | public domain dedication and license | (?:open data commons )?public domain dedication and license
ogl-uk-3.0 | 80 | open government licen | open government licen[cs]e (?:version |v )?3 0
ogl-uk | 50 | open government licen | open government licen[cs]e
cdla-permissive | 80 | community data license agreement | community data license agreement permissive
cdla-sharing | 80 | community data license agreement | community data license agreement sharing
openrail | 70 | openrail | (?:creativeml |bigscience )?openrail(?: m)?(?: license)?
llama-community | 70 | community license agreement | llama (?:[23] )?community license agreement
gfdl | 60 | free documentation license | (?:gnu )?free documentation license
public-domain | 80 | public domain | (?:released|dedicated|placed) (?:in|into|to) the public domain
public-domain | 50 | public domain | (?:in the )?public domain
public-domain | 60 | no known copyright | no known copyright restrictions
cc0-1.0 | 90 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 80 | creative commons zero | creative commons zero(?: v? ?1 0)?
creative-commons | 30 | creative commons | creative commons(?: licen[cs]e)?
creative-commons | 35 | creativecommons org | creativecommons org licen[cs]es
cc-nc | 45 | non commercial use only | for non commercial use only
cc-nc | 45 | noncommercial | noncommercial use only
gpl | 60 | gpl | gpl compatible
gpl | 55 | gnu gpl | gnu gpl
copyleft | 40 | copyleft | copyleft
free-software | 50 | free software you can redistribute | this program is free software you can redistribute it and or modify
no-warranty | 35 | without any warranty | without any warranty
no-warranty | 35 | as is basis | on an as is basis
no-warranty | 35 | warranties or conditions | without warranties or conditions of any kind
spdx | 65 | spdx license identifier | spdx license identifier [0-9a-z]+
copyright-notice | 40 | copyright | copyright (?:c )?(?:19|20)[0-9]{2}
copyright-notice | 30 | copyright | copyright (?:c )?by
copyright-notice | 25 | copyright | copyright holders?
copyright-notice | 25 | copyrighted | copyrighted (?:material|work|content)
reserved-some | 70 | some rights reserved | some rights reserved
reserved-no | 70 | no rights reserved | no rights reserved
reserved-all | 60 | rights reserved | all rights (?:are )?reserved
reserved-all | 65 | rights reserved | copyright (?:c )?(?:19|20)[0-9]{2} (?:[^ ]+ ){0,6}all rights reserved
proprietary | 70 | proprietary and confidential | proprietary and confidential
proprietary | 60 | proprietary licen | proprietary licen[cs]e
proprietary | 60 | unauthori | unauthori[sz]ed (?:copying|reproduction|distribution|use)(?: of this (?:file|work|material))?
proprietary | 60 | may not be reproduced | may not be reproduced(?: or (?:distributed|transmitted))?
proprietary | 55 | without prior written permission | without (?:the )?prior written permission
proprietary | 50 | without permission | (?:reproduced|reprinted|copied) without permission
proprietary | 50 | trade secret | trade secrets?
proprietary | 55 | under license from | (?:used )?under license from
personal-use | 55 | personal use only | for personal use only
educational-use | 55 | educational use only | for educational use only
evaluation-use | 55 | evaluation purposes | for evaluation purposes only
research-use | 55 | research purposes only | for research purposes only
eula | 60 | end user license agreement | end user license agreement
terms-of-use | 40 | terms of use | terms of use
terms-of-service | 40 | terms of service | terms of service
reprint-permission | 45 | reprinted with permission | reprinted with (?:the )?permission
reprint-permission | 45 | used with permission | used with permission
fair-use | 40 | fair use | fair use
trademark-notice | 30 | trademark | (?:registered )?trademarks? of
patent-notice | 30 | patent | patents? pending
licensed-under | 20 | licensed under | (?:is )?licensed under(?: the)?
license-file | 30 | license | see (?:the )?license(?: file)?
license-file | 30 | license | license (?:txt|md)
dual-licensed | 50 | dual licensed | dual licensed
"""

#: Rules of at least this priority also take the words that lead to a license name.
LEAD, LEAD_FROM = "(?:licensed under (?:the )?)?", 40

#: Product kinds whose versions and wordings are written by rule below.
CC_KINDS = {
    "by-nc-nd": ("by nc nd", "attribution non ?commercial no ?deriv(?:s|atives)"),
    "by-nc-sa": ("by nc sa", "attribution non ?commercial share ?alike"),
    "by-nc": ("by nc", "attribution non ?commercial"),
    "by-nd": ("by nd", "attribution no ?deriv(?:s|atives)"),
    "by-sa": ("by sa", "attribution share ?alike"),
    "by": ("by", "attribution"),
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
GNU_KINDS = {
    "agpl": ("agpl", "affero general public license", "affero general public license", ("1.0", "3.0")),
    "lgpl": ("lgpl", "general public license", "(?:lesser|library) general public license", ("2.0", "2.1", "3.0")),
    "gpl": ("gpl", "general public license", "general public license", ("1.0", "2.0", "3.0")),
}


def _cc() -> list[tuple[str, int, str, str]]:
    rules = []
    for kind, (short, long) in CC_KINDS.items():
        for version in CC_VERSIONS:
            number = version.replace(".", " ")
            rules.append((f"cc-{kind}-{version}", 90, f"cc {short}", f"cc {short} (?:v )?{number}"))
            full = f"creative commons {long} (?:{number}|(?:[a-z]+ ){{0,3}}{number})"
            rules.append((f"cc-{kind}-{version}", 90, "creative commons", full))
            rules.append((f"cc-{kind}-{version}", 85, f"licenses {short}", f"licenses {short} {number}"))
        rules.append((f"cc-{kind}", 60, f"cc {short}", f"cc {short}"))
        rules.append((f"cc-{kind}", 60, "creative commons", f"creative commons {long}"))
    return rules


def _gnu() -> list[tuple[str, int, str, str]]:
    rules = []
    for kind, (short, keyword, long, versions) in GNU_KINDS.items():
        for version in versions:
            major = version.split(".")[0]
            number = f"{major}(?: {version.split('.')[1]})?" if version.endswith(".0") else version.replace(".", " ")
            for suffix, later in (("", ""), ("-or-later", " (?:or|and) (?:any )?later(?: versions?)?"), ("-only", " only")):
                rank = 85 + 5 * bool(later)
                rules.append((f"{kind}-{version}{suffix}", rank, keyword, f"(?:gnu )?{long} (?:version |v )?{number}{later}"))
                rules.append((f"{kind}-{version}{suffix}", rank - 5, short, f"{short} ?v? ?{number}{later}"))
        rules.append((kind, 60, keyword, f"(?:gnu )?{long}"))
        rules.append((kind, 40, short, short))
    return rules


def rules() -> list[tuple[str, int, str, str]]:
    """(label, priority, keyword, regex) in the order that settles ties: hand-written first."""
    written = []
    for line in HAND_WRITTEN.strip().splitlines():
        label, priority, keyword, regex = (x.strip() for x in line.split(" | ", 3))
        written.append((label, int(priority), keyword, regex))
    return [(label, p, keyword, LEAD + regex if p >= LEAD_FROM else regex) for label, p, keyword, regex in written + _cc() + _gnu()]
