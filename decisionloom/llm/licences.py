"""Licence scans by ordered signature rules; DataFrame functions only.

A rule is a regular expression over a text's words (A-Z lower-cased, one space between words), a
keyword that every match holds, a label, a priority and a weight.  Signatures are written by hand:
tags of files, addresses, notices of headers, sentences of the licences' bodies.  Names, with their
versions and identifiers, are rules too, one for each family and sentence form.

* A text that holds none of the gate's keywords is not looked at again; its words are counted only.
* Of the others, the words around each keyword make zones, and a zone is searched by the rules whose
  keyword it holds.  Every pattern is a literal of the plan, so it is compiled once a task.
* A zone's places are taken in the order of priority, length (longest first), start and label; a
  place that overlaps one taken before, or lies within it, is suppressed.

What is left gives the labels and the score, the largest weight.  The four base phrases are counted
on their own, over all words, and always keep their labels.

Cases: null and empty texts have no words, places or labels, and score 0; long texts are scanned
whole; repeated rows are scanned alike; other columns are ignored, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import ascii_lower, table

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of a text whose capitals are still there.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Signatures, a line each: label, priority, weight, keyword, pattern.  A keyword is part of every match.
SIGNATURES = r"""
mit            | 95 | 1.0  | license identifier     | spdx license identifier mit
mit            | 92 | 0.9  | licenses mit           | opensource org licenses mit(?: license)?(?: php| html)?
mit            | 92 | 0.9  | spdx org licenses mit  | spdx org licenses mit(?: html)?
mit            | 85 | 1.0  | permission is hereby   | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit            | 84 | 0.9  | sublicense             | without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software(?: and to permit persons to whom the software is furnished to do so)?
mit-0          | 96 | 1.0  | license identifier     | spdx license identifier mit 0
mit-0          | 92 | 0.9  | licenses mit 0         | opensource org licenses mit 0
x11            | 95 | 1.0  | license identifier     | spdx license identifier x11
isc            | 95 | 1.0  | license identifier     | spdx license identifier isc
isc            | 92 | 0.9  | licenses isc           | opensource org licenses isc(?: license)?(?: php| html| txt)?
isc            | 84 | 1.0  | hereby                 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc            | 83 | 0.8  | hereby                 | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
hpnd           | 82 | 0.9  | hereby                 | permission to use copy modify and distribute this software and its documentation for any purpose (?:and without fee|and without a written agreement|with or without fee) is hereby granted
hpnd           | 95 | 1.0  | license identifier     | spdx license identifier hpnd
ntp            | 83 | 0.9  | hereby                 | permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted provided that the above copyright notice appears in all copies
bsd            | 80 | 0.8  | redistribution         | redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?
bsd            | 79 | 0.7  | redistribution         | redistributions? of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd-2-clause   | 92 | 0.9  | licenses bsd 2 clause  | opensource org licenses bsd 2 clause
bsd-3-clause   | 92 | 0.9  | licenses bsd 3 clause  | opensource org licenses bsd 3 clause
bsd            | 92 | 0.8  | licenses bsd license   | opensource org licenses bsd license(?: php| html)?
bsd-2-clause   | 95 | 1.0  | license identifier     | spdx license identifier bsd 2 clause(?: patent| views)?
bsd-3-clause   | 95 | 1.0  | license identifier     | spdx license identifier bsd 3 clause(?: clear| lbnl| attribution)?
bsd-4-clause   | 95 | 1.0  | license identifier     | spdx license identifier bsd 4 clause
bsd            | 90 | 0.9  | bsd style license      | (?:use of this source code is )?governed by a bsd style license that can be found in the license file
bsd-4-clause   | 85 | 1.0  | redistribution         | redistribution and use .{20,400} all advertising materials mentioning features or use of this software must display
0bsd           | 95 | 1.0  | license identifier     | spdx license identifier 0bsd
apache-2.0     | 95 | 1.0  | license identifier     | spdx license identifier apache 2 0
apache-1.1     | 95 | 1.0  | license identifier     | spdx license identifier apache 1 1
apache-1.0     | 95 | 1.0  | license identifier     | spdx license identifier apache 1 0
apache-2.0     | 93 | 1.0  | licenses license 2 0   | apache org licenses license 2 0(?: txt| html)?
apache-2.0     | 92 | 0.9  | licenses apache 2 0    | opensource org licenses apache 2 0
apache-1.1     | 93 | 1.0  | licenses license 1 1   | apache org licenses license 1 1
apache-2.0     | 90 | 1.0  | apache license         | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0     | 85 | 0.9  | license                | licensed to the apache software foundation asf under one or more contributor license agreements
apache-2.0     | 84 | 0.8  | license                | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0     | 84 | 0.9  | license                | grant of (?:copyright|patent) license subject to the terms and conditions of this license each contributor hereby grants
apache         | 75 | 0.8  | licenses               | apache org licenses
gpl-2.0        | 95 | 1.0  | license identifier     | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3.0        | 95 | 1.0  | license identifier     | spdx license identifier gpl 3 0(?: only| or later)?
gpl-1.0        | 95 | 1.0  | license identifier     | spdx license identifier gpl 1 0(?: only| or later)?
gpl-2.0        | 92 | 0.9  | licenses gpl 2 0       | (?:gnu|fsf) org (?:old )?licenses(?: old licenses)? gpl 2 0(?: html| txt)?
gpl-2.0        | 92 | 0.9  | licenses old           | gnu org licenses old licenses gpl 2 0(?: html| txt| en html)?
gpl-3.0        | 92 | 0.9  | licenses gpl 3         | gnu org licenses gpl 3 0(?: html| txt| en html)?
gpl            | 91 | 0.8  | licenses gpl           | gnu org licenses gpl(?: html| txt| en html)?
gpl            | 91 | 0.8  | gnu org copyleft gpl   | gnu org copyleft gpl(?: html| txt)?
gpl-2.0        | 88 | 1.0  | gnu general public license | (?:redistribute it and or modify it )?under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0        | 88 | 1.0  | gnu general public license | (?:redistribute it and or modify it )?under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0        | 87 | 1.0  | gnu general public license | under the terms of the gnu general public license version 2(?: only)?(?: as published by the free software foundation)?
gpl-3.0        | 87 | 1.0  | gnu general public license | under the terms of the gnu general public license version 3(?: only)?(?: as published by the free software foundation)?
gpl            | 80 | 0.7  | gnu general public license | see the gnu general public license for more details
gpl            | 80 | 0.7  | gnu general public license | you should have received a copy of the gnu general public license(?: along with this (?:program|software|library|file))?
gpl            | 78 | 0.7  | general public license | the gnu general public license is a free copyleft license for software and other kinds of works
gpl-classpath  | 94 | 1.0  | classpath exception    | gpl 2 0(?: only| or later)? with classpath exception 2 0
gpl-classpath  | 89 | 0.9  | classpath exception    | designates? this particular file as subject to the classpath exception
lgpl           | 95 | 1.0  | license identifier     | spdx license identifier lgpl [23] [01](?: only| or later)?
lgpl           | 92 | 0.9  | gnu org                | gnu org (?:copyleft|licenses) lgpl(?: [23] [01])?(?: html| txt| en html)?
lgpl           | 89 | 1.0  | gnu lesser general public license | under the terms of the gnu lesser general public license as published by the free software foundation(?: either)? version (?:2 1|2|3)(?: of the license)?
lgpl           | 89 | 1.0  | gnu library general public license | under the terms of the gnu library general public license as published by the free software foundation(?: either)? version 2(?: of the license)?
lgpl           | 82 | 0.7  | gnu lesser general public license | you should have received a copy of the gnu lesser general public license
lgpl           | 82 | 0.7  | gnu lesser general public license | see the gnu lesser general public license for more details
agpl           | 95 | 1.0  | license identifier     | spdx license identifier agpl [13] 0(?: only| or later)?
agpl           | 92 | 0.9  | licenses agpl          | gnu org licenses agpl(?: 3 0)?(?: html| txt| en html)?
agpl           | 89 | 1.0  | gnu affero general public license | under the terms of the gnu affero general public license as published by the free software foundation(?: either)? version 3(?: of the license)?
agpl           | 82 | 0.7  | gnu affero general public license | you should have received a copy of the gnu affero general public license
gfdl           | 95 | 1.0  | license identifier     | spdx license identifier gfdl 1 [123](?: only| or later| invariants only| no invariants only)*
gfdl           | 92 | 0.9  | gnu org                | gnu org (?:copyleft|licenses) fdl(?: 1 [123])?(?: html| txt)?
gfdl           | 88 | 1.0  | gnu free documentation license | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 [123]
mpl            | 95 | 1.0  | license identifier     | spdx license identifier mpl [12] [01](?: no copyleft exception)?
mpl            | 92 | 0.9  | mozilla org mpl        | mozilla org mpl(?: 2 0| mpl 1 1)?(?: html| txt)?(?: license)?
mpl            | 88 | 1.0  | mozilla public license | this source code form is subject to the terms of the mozilla public license v 2 0
mpl            | 88 | 1.0  | mozilla public license | the contents of this file are subject to the mozilla public license version 1 [01] the license
mpl            | 84 | 0.8  | mozilla org mpl        | if a copy of the mpl was not distributed with this file you can obtain one at (?:https? )?(?:www )?mozilla org mpl 2 0
epl            | 95 | 1.0  | license identifier     | spdx license identifier epl [12] 0
epl            | 92 | 0.9  | eclipse org            | eclipse org (?:org documents |legal )(?:legal )?epl (?:v10|v20|2 0)(?: html)?
epl            | 88 | 1.0  | eclipse public license | made available under the terms of the eclipse public license (?:v1 0|v 1 0|v 2 0|2 0)(?: which (?:accompanies this distribution|is available at))?
cddl           | 95 | 1.0  | license identifier     | spdx license identifier cddl 1 [01]
cddl           | 88 | 1.0  | development and distribution license | the contents of this file are subject to the terms of the common development and distribution license
cddl           | 92 | 0.9  | licenses cddl          | opensource org licenses cddl(?: 1)?(?: 0)?
cpl            | 95 | 1.0  | license identifier     | spdx license identifier cpl 1 0
cpl            | 70 | 0.7  | common public license  | common public license(?: version)?(?: 1 0)?
ipl            | 70 | 0.7  | ibm public license     | ibm public license(?: version)?(?: 1 0)?
artistic       | 95 | 1.0  | license identifier     | spdx license identifier artistic [12] 0(?: perl| cl8)?
artistic       | 86 | 1.0  | perl itself            | this (?:library|program|module|package|software) is free software you can redistribute it and or modify it under the same terms as perl itself
artistic       | 92 | 0.9  | licenses artistic      | opensource org licenses artistic license(?: 2 0| 1 0)?
boost          | 95 | 1.0  | license identifier     | spdx license identifier bsl 1 0
boost          | 92 | 0.9  | boost org license      | boost org license 1 0 txt
boost          | 88 | 1.0  | boost software license | distributed under the boost software license version 1 0
boost          | 84 | 0.9  | hereby                 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
busl           | 95 | 1.0  | license identifier     | spdx license identifier busl 1 1
busl           | 70 | 0.8  | business source license | business source license(?: 1 1)?
sspl           | 95 | 1.0  | license identifier     | spdx license identifier sspl 1 0
sspl           | 70 | 0.8  | server side public license | server side public license(?: version)?(?: 1)?
elastic        | 95 | 1.0  | license identifier     | spdx license identifier elastic 2 0
elastic        | 70 | 0.8  | elastic license        | elastic license(?: v2| 2 0)?
zlib           | 95 | 1.0  | license identifier     | spdx license identifier zlib(?: acknowledgement)?
zlib           | 84 | 0.9  | implied warranty       | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
zlib           | 92 | 0.9  | licenses zlib          | opensource org licenses zlib(?: license)?(?: php)?
unlicense      | 95 | 1.0  | license identifier     | spdx license identifier unlicense
unlicense      | 92 | 0.9  | unlicense org          | unlicense org
unlicense      | 85 | 1.0  | public domain          | this is free and unencumbered software released into the public domain
wtfpl          | 95 | 1.0  | license identifier     | spdx license identifier wtfpl
wtfpl          | 92 | 0.9  | wtfpl net              | wtfpl net(?: txt copying| about)?
beerware       | 95 | 1.0  | license identifier     | spdx license identifier beerware
beerware       | 70 | 0.8  | beer ware license      | (?:the )?beer ware license(?: revision 42)?
eupl           | 95 | 1.0  | license identifier     | spdx license identifier eupl 1 [012]
eupl           | 88 | 1.0  | eupl                   | licensed under the eupl(?: version)?(?: v)?(?: 1 [012])?(?: or as soon they will be approved by the european commission)?
ofl            | 95 | 1.0  | license identifier     | spdx license identifier ofl 1 [01](?: rfn| no rfn)?
ofl            | 92 | 0.9  | licenses ofl           | scripts sil org ofl licenses ofl
ofl            | 88 | 1.0  | sil open font license  | this font software is licensed under the sil open font license version 1 1
psf            | 95 | 1.0  | license identifier     | spdx license identifier (?:psf|python) 2 0(?: 1)?
psf            | 80 | 0.8  | python software foundation license | python software foundation license(?: agreement)?(?: for python)?(?: version 2)?
php            | 95 | 1.0  | license identifier     | spdx license identifier php 3 0(?: 1)?
php            | 92 | 0.9  | php net license        | php net license 3 01? txt
ruby           | 95 | 1.0  | license identifier     | spdx license identifier ruby
ruby           | 60 | 0.6  | ruby license           | ruby license
openssl        | 95 | 1.0  | license identifier     | spdx license identifier openssl
openssl        | 70 | 0.7  | openssl license        | openssl license
postgresql     | 95 | 1.0  | license identifier     | spdx license identifier postgresql
ncsa           | 95 | 1.0  | license identifier     | spdx license identifier ncsa
ncsa           | 70 | 0.8  | ncsa open source license | (?:university of illinois )?ncsa open source license
afl            | 95 | 1.0  | license identifier     | spdx license identifier afl [123] [012]
afl            | 70 | 0.8  | academic free license  | academic free license(?: version)?(?: v)?(?: [123] [012])?
osl            | 95 | 1.0  | license identifier     | spdx license identifier osl [123] [01]
osl            | 70 | 0.8  | open software license  | open software license(?: version)?(?: v)?(?: [123] [01])?
ms-pl          | 95 | 1.0  | license identifier     | spdx license identifier ms pl
ms-rl          | 95 | 1.0  | license identifier     | spdx license identifier ms rl
cecill         | 95 | 1.0  | license identifier     | spdx license identifier cecill [12] [01](?: b| c)?
cecill         | 70 | 0.8  | cecill                 | governed by the cecill(?: b| c)? license
odbl           | 95 | 1.0  | license identifier     | spdx license identifier odbl 1 0
odbl           | 92 | 0.9  | licenses odbl          | opendatacommons org licenses odbl(?: 1 0)?
odc-by         | 92 | 0.9  | licenses by            | opendatacommons org licenses by(?: 1 0)?
odc-by         | 70 | 0.8  | open data commons attribution license | open data commons attribution license
pddl           | 92 | 0.9  | licenses pddl          | opendatacommons org licenses pddl(?: 1 0)?
pddl           | 70 | 0.8  | public domain          | public domain dedication and license
cc0            | 95 | 1.0  | license identifier     | spdx license identifier cc0 1 0
cc0            | 93 | 1.0  | creativecommons        | creativecommons org publicdomain zero 1 0(?: legalcode)?
cc-pdm         | 93 | 0.9  | creativecommons        | creativecommons org publicdomain mark 1 0
cc-by          | 93 | 1.0  | creativecommons        | creativecommons org licenses by [1234] [05](?: legalcode| deed)?
cc-by-sa       | 94 | 1.0  | creativecommons        | creativecommons org licenses by sa [1234] [05](?: legalcode| deed)?
cc-by-nc       | 94 | 1.0  | creativecommons        | creativecommons org licenses by nc [1234] [05](?: legalcode| deed)?
cc-by-nd       | 94 | 1.0  | creativecommons        | creativecommons org licenses by nd [1234] [05](?: legalcode| deed)?
cc-by-nc-sa    | 95 | 1.0  | creativecommons        | creativecommons org licenses by nc sa [1234] [05](?: legalcode| deed)?
cc-by-nc-nd    | 95 | 1.0  | creativecommons        | creativecommons org licenses by nc nd [1234] [05](?: legalcode| deed)?
cc-by-sa       | 88 | 0.9  | creative commons       | text is available under the creative commons attribution sharealike license
public-domain  | 75 | 0.8  | public domain          | (?:this (?:work|file|software|code|program|document|text) (?:is|has been) )(?:hereby )?(?:placed |released )?(?:in|into) the public domain
public-domain  | 74 | 0.8  | public domain          | dedicates? (?:this work|any and all copyright interest in the software) to the public domain
proprietary    | 75 | 0.9  | proprietary            | (?:confidential and proprietary|proprietary and confidential)(?: information)?
proprietary    | 74 | 0.9  | proprietary            | unauthorized copying of this file via any medium is strictly prohibited proprietary and confidential
all-rights-reserved | 45 | 0.4 | rights reserved      | copyright (?:c )?(?:\d{4} ){1,4}(?:\S+ ){0,6}all rights reserved
no-commercial  | 60 | 0.7  | licen                  | licen[cs]ed? for (?:personal and )?(?:non commercial|noncommercial) use(?: only)?
commercial     | 60 | 0.6  | commercial license     | (?:subject to|under) (?:a|the|our) commercial license(?: agreement)?
eula           | 60 | 0.6  | user license           | end user license agreement
"""

#: label: priority, keyword, names, versions, identifiers after "spdx license identifier".
FAMILIES: dict[str, tuple[int, str, list[str], list[str], list[str]]] = {
    "gpl-2.0": (60, "gnu", ["gnu general public license", "gnu gpl", "gpl"], ["2", "2 0", "v2"], ["gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later"]),
    "gpl-3.0": (60, "gnu", ["gnu general public license", "gnu gpl", "gpl"], ["3", "3 0", "v3"], ["gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later"]),
    "lgpl": (70, "gnu", ["gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"], ["2", "2 1", "3", "3 0"], ["lgpl 2 1", "lgpl 2 1 only", "lgpl 3 0", "lgpl 3 0 or later"]),
    "agpl": (70, "gnu", ["gnu affero general public license", "affero general public license", "gnu agpl", "agpl"], ["3", "3 0", "v3"], ["agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later"]),
    "gfdl": (70, "gnu", ["gnu free documentation license", "gfdl"], ["1 1", "1 2", "1 3"], ["gfdl 1 2", "gfdl 1 3"]),
    "gpl": (40, "gnu", ["gnu general public license", "gnu gpl"], [], ["gpl"]),
    "apache-2.0": (60, "apache", ["apache license", "apache software license"], ["2", "2 0", "v2"], ["apache 2 0"]),
    "apache-1.1": (60, "apache", ["apache license", "apache software license"], ["1 1"], ["apache 1 1"]),
    "apache": (40, "apache", ["apache license", "apache software license"], [], ["apache"]),
    "mit": (40, "mit", ["mit license", "mit licence", "mit x11 license", "expat license"], [], ["mit"]),
    "mit-0": (60, "mit", ["mit no attribution license", "mit license no attribution"], [], ["mit 0"]),
    "x11": (50, "x11", ["x11 license", "x consortium license"], [], ["x11"]),
    "bsd-2-clause": (60, "bsd", ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "freebsd license"], [], ["bsd 2 clause"]),
    "bsd-3-clause": (60, "bsd", ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license"], [], ["bsd 3 clause"]),
    "bsd-4-clause": (60, "bsd", ["bsd 4 clause license", "4 clause bsd license", "original bsd license"], [], ["bsd 4 clause"]),
    "bsd": (40, "bsd", ["bsd license", "bsd licence", "bsd style license"], [], ["bsd"]),
    "isc": (50, "isc", ["isc license", "isc licence"], [], ["isc"]),
    "mpl": (50, "mozilla", ["mozilla public license", "mozilla public licence"], ["1 0", "1 1", "2", "2 0"], ["mpl 1 1", "mpl 2 0"]),
    "epl": (50, "eclipse", ["eclipse public license"], ["1 0", "2 0"], ["epl 1 0", "epl 2 0"]),
    "cddl": (50, "cddl", ["common development and distribution license", "cddl"], ["1 0", "1 1"], ["cddl 1 0", "cddl 1 1"]),
    "artistic": (50, "artistic", ["artistic license", "perl artistic license"], ["1 0", "2", "2 0"], ["artistic 1 0", "artistic 2 0"]),
    "boost": (50, "boost", ["boost software license"], ["1", "1 0"], ["bsl 1 0"]),
    "zlib": (50, "zlib", ["zlib license", "zlib libpng license"], [], ["zlib"]),
    "unlicense": (50, "unlicense", ["the unlicense", "unlicense license"], [], ["unlicense"]),
    "wtfpl": (50, "wtfpl", ["wtfpl", "do what the fuck you want to public license"], ["2"], ["wtfpl"]),
    "eupl": (50, "eupl", ["european union public licence", "european union public license", "eupl"], ["1 1", "1 2"], ["eupl 1 1", "eupl 1 2"]),
    "ofl": (50, "ofl", ["sil open font license", "open font license"], ["1 0", "1 1"], ["ofl 1 1"]),
    "psf": (50, "python", ["python software foundation license", "python license"], ["2", "2 0"], ["psf 2 0", "python 2 0"]),
    "php": (50, "php", ["php license"], ["3 0", "3 01"], ["php 3 0", "php 3 01"]),
    "postgresql": (50, "postgresql", ["postgresql license", "postgresql licence"], [], ["postgresql"]),
    "ms-pl": (50, "microsoft", ["microsoft public license"], [], ["ms pl"]),
    "ms-rl": (50, "microsoft", ["microsoft reciprocal license"], [], ["ms rl"]),
    "odbl": (50, "odbl", ["open database license", "odbl"], ["1 0"], ["odbl 1 0"]),
    "cc0": (60, "cc0", ["cc0", "creative commons zero"], ["1 0"], ["cc0 1 0"]),
    "cc-by-nc-nd": (80, "cc", ["cc by nc nd", "creative commons attribution noncommercial noderivatives", "creative commons attribution non commercial no derivatives"], ["2 0", "3 0", "4 0"], ["cc by nc nd 3 0", "cc by nc nd 4 0"]),
    "cc-by-nc-sa": (80, "cc", ["cc by nc sa", "creative commons attribution noncommercial sharealike", "creative commons attribution non commercial share alike"], ["2 0", "3 0", "4 0"], ["cc by nc sa 3 0", "cc by nc sa 4 0"]),
    "cc-by-nc": (70, "cc", ["cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"], ["2 0", "3 0", "4 0"], ["cc by nc 3 0", "cc by nc 4 0"]),
    "cc-by-sa": (70, "cc", ["cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"], ["2 0", "3 0", "4 0"], ["cc by sa 3 0", "cc by sa 4 0"]),
    "cc-by-nd": (70, "cc", ["cc by nd", "creative commons attribution noderivatives", "creative commons attribution no derivatives"], ["2 0", "3 0", "4 0"], ["cc by nd 3 0", "cc by nd 4 0"]),
    "cc-by": (50, "cc", ["cc by", "creative commons attribution"], ["2 0", "2 5", "3 0", "4 0"], ["cc by 3 0", "cc by 4 0"]),
    "public-domain": (30, "public domain", ["in the public domain", "dedicated to the public domain", "released into the public domain"], [], []),
    "all-rights-reserved": (20, "all rights reserved", ["all rights reserved"], [], []),
    "proprietary": (20, "proprietary", ["proprietary and confidential", "proprietary license"], [], []),
}

#: Sentence forms around a name, and what each adds to the priority and is worth.
FORMS = [
    (r"{name}", 0, 0.6),
    (r"(?:licensed|released|distributed|available|published|made available) under (?:the )?(?:terms of the )?{name}", 5, 0.9),
    (r"(?:this (?:work|software|file|program|project) is )(?:free software )?(?:licensed|released|distributed|covered) (?:under|by) (?:the )?{name}", 6, 0.95),
    (r"(?:see|read|subject to|under the terms of) (?:the )?{name}", 4, 0.8),
]
VERSIONED = r"{name} (?:version |v )?(?:{version})(?: or (?:any )?later(?: version)?| only)?"


class Rule(NamedTuple):
    label: str
    priority: int
    weight: float
    keywords: tuple[str, ...]
    pattern: str


def _any_of(words: list[str]) -> str:
    return "(?:" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")"


def rules() -> list[Rule]:
    out = []
    for line in SIGNATURES.strip().splitlines():
        label, priority, weight, keyword, pattern = (x.strip() for x in line.split(" | ", 4))
        out.append(Rule(label, int(priority), float(weight), (keyword,), pattern))
    for label, (priority, _, names, versions, ids) in FAMILIES.items():
        name, keys = _any_of(names), tuple(names)
        if label not in ONLY_VERSIONED:
            out += [Rule(label, priority + p, w, keys, f.format(name=name)) for f, p, w in FORMS]
        if versions:
            with_version = VERSIONED.format(name=name, version=_any_of(versions)[3:-1])
            out += [Rule(label, priority + p + 10, min(1.0, w + 0.1), keys, f.format(name=with_version)) for f, p, w in FORMS[:2]]
        if ids:
            out.append(Rule(label, priority + 30, 1.0, ("spdx license identifier",), f"spdx license identifier {_any_of(ids)}"))
    return out


#: Families whose name alone doesn't tell the version.
ONLY_VERSIONED = ("gpl-2.0", "gpl-3.0", "apache-2.0", "apache-1.1")
RULES = rules()
#: One of these is part of every match of every rule; a text without any is not looked at again.
GATE = ["licen", "gpl", "cc by", "cc0", "creative commons", "creativecommons", "public domain", "rights reserved", "proprietary", "gfdl", "wtfpl", "cddl", "eupl", "odbl", "redistribution", "hereby", "classpath exception", "copyleft", "perl itself", "mozilla org mpl", "eclipse org", "gnu org", "cecill", "boost org", "implied warranty", "free software released"]
#: What a text as it was written holds, in lower case, if its words hold one of the gate's keywords.
RAW_GATE = ["licen", "gpl", "cc", "creative", "domain", "reserved", "proprietary", "gfdl", "wtfpl", "cddl", "eupl", "odbl", "redistribution", "hereby", "classpath", "copyleft", "perl", "mozilla", "eclipse", "gnu", "cecill", "boost", "implied", "software"]
#: Characters on both sides of a keyword that its zone holds; no match reaches further.
AROUND = 700


def words_of(text):
    """A text's words with a space before, between and after them; one space if there are none."""
    plain = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD, " ")
    return F.concat(F.lit(" "), F.trim(plain), F.lit(" "))


def _count(words):
    """Words of a string that begins and ends with a space."""
    return F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) - 1


def _base_pattern() -> str:
    return "(?<= )(?:" + "|".join(BASE) + ")(?= )"


def _zones(words):
    """The parts of a text, as it stands among its words, around the gate's keywords: array of strings."""
    key = "|".join(GATE)
    hits = F.regexp_extract_all(words, F.lit(f"(?:{key})"), F.lit(0))
    gaps = F.split(words, key, -1)
    none = F.array().cast("array<string>")

    def step(acc, x):
        far = F.length(x["gap"]) > 2 * AROUND
        joined = F.concat(acc["open"], x["gap"], x["hit"])
        return F.when(
            far, F.struct(F.concat(acc["done"], F.array(F.concat(acc["open"], F.left(x["gap"], F.lit(AROUND))))).alias("done"), F.concat(F.right(x["gap"], F.lit(AROUND)), x["hit"]).alias("open"))
        ).otherwise(F.struct(acc["done"].alias("done"), joined.alias("open")))

    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"))
    last = F.left(F.element_at(gaps, -1), F.lit(AROUND))
    return F.aggregate(pairs, F.struct(none.alias("done"), F.lit("").alias("open")), step, lambda acc: F.array_distinct(F.concat(acc["done"], F.array(F.concat(acc["open"], last)))))


PLACES = "array<struct<minus_priority:int,minus_length:int,start:int,label:string,weight:double>>"
NO_PLACES = f"CAST(array() AS {PLACES})"


def _places(rule: Rule) -> str:
    """SQL: where a rule matches in the zone z; the next place of what was found, between spaces, is where the rule matched."""
    at = "position(concat(' ', hit, ' '), z, acc.at)"
    one = f"named_struct('minus_priority', {-rule.priority}, 'minus_length', -length(hit), 'start', {at}, 'label', '{rule.label}', 'weight', {rule.weight}D)"
    return f"aggregate(regexp_extract_all(z, r'(?<= )(?:{rule.pattern})(?= )', 0), named_struct('at', 1, 'all', {NO_PLACES}), (acc, hit) -> named_struct('at', {at} + length(hit) + 1, 'all', concat(acc.all, array({one}))), acc -> acc.all)"


def _detections() -> str:
    """SQL: all places of all rules whose keyword the zone z holds, in the order in which they are taken."""
    by: dict[tuple, list] = {}
    for rule in RULES:
        by.setdefault(rule.keywords, []).append(rule)
    parts = []
    for keywords, some in by.items():
        held = " OR ".join(f"contains(z, '{k}')" for k in keywords)
        parts.append(f"if({held}, concat({NO_PLACES}, {', '.join(map(_places, some))}), {NO_PLACES})")
    return f"array_sort(concat({', '.join(parts)}))"


def _resolved(detections: str) -> str:
    """SQL: the places that overlap none taken before."""
    return f"aggregate({detections}, {NO_PLACES}, (acc, d) -> if(exists(acc, p -> p.start < d.start - d.minus_length AND d.start < p.start - p.minus_length), acc, concat(acc, array(d))))"


def scan(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = _base_pattern()
    rows = docs.select("doc_id", "text", F.lower("text").alias("lower"))  # a projection of its own, as every keyword looks into it
    open_ = F.lit(False)
    for k in RAW_GATE:
        open_ = open_ | F.contains("lower", F.lit(k))
    n_words = F.coalesce(F.regexp_count("text", F.lit(ANY_WORD)), F.lit(0)).cast("long")
    words = rows.select("doc_id", n_words.alias("n_words"), F.when(F.coalesce(open_, F.lit(False)), words_of(F.col("text"))).alias("words"))
    none = F.array().cast("array<string>")
    hits = F.coalesce(F.regexp_extract_all("words", F.lit(base), F.lit(0)), none)
    zones = F.when(F.col("words").rlike("|".join(GATE)), _zones(F.col("words")))
    rows = words.withColumn("hits", hits).withColumn("zones", zones)
    rows = rows.withColumn("found", F.expr(f"flatten(transform(zones, z -> {_resolved(_detections())}))"))  # as SQL, since thousands of Column calls take seconds
    some = F.size("hits") > 0
    gaps = F.split("words", base, -1)
    first = F.when(some, _count(F.element_at(gaps, 1)))
    last = F.when(some, F.col("n_words") - _count(F.element_at(gaps, -1)) - _count(F.concat(F.lit(" "), F.element_at("hits", -1), F.lit(" "))))
    of_base = F.filter(F.array_sort(F.array(*[F.when(F.array_contains("hits", p), F.lit(x)) for p, x in BASE.items()])), lambda x: x.isNotNull())
    both = F.array_sort(F.array_union(of_base, F.coalesce(F.array_distinct("found.label"), none)))
    score = F.greatest(F.coalesce(F.array_max("found.weight"), F.lit(0.0)), F.when(some, F.lit(0.6)).otherwise(F.lit(0.0)))
    return rows.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_base"), first.cast("long").alias("first_word"), last.cast("long").alias("last_word"), F.array_join(of_base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), score.alias("score"))


def op5_licence_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
