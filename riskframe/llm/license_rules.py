"""Ordered licence signatures: one per line, ``label | tier | keyword | pattern``, earlier lines first.

A pattern runs over words (a-z lower-cased, digits, everything beyond ASCII) joined by one space, so "Version 2.0" is
``version 2 0``. Exactly one word carries ``@``: the anchor, at which the pattern is tried, and every match holds it.
The keyword must stand in the words around the anchor before the pattern is run at all. Patterns use only groups,
alternatives, classes and bounded repeats, span at most SIDE words to each side of the anchor.

Tiers: 0 clause of a licence text, 1 SPDX tag or address, 2 grant or name with its version, 3 name, 4 vague mention.
"""

from __future__ import annotations

#: Words to each side of an anchor that a pattern can see.
SIDE = 32
#: How sure a signature of each tier is.
STRENGTH = (1.0, 0.95, 0.9, 0.75, 0.4)
#: Every anchor holds one of these; a text without any of them has no detection.
STEMS = ("licen", "copyright", "hereby", "redistribution", "warrant", "domain", "gpl", "reserved", "commons", "wtfpl",
         "copyleft", "beerware")

SIGNATURES = r"""
mit | 0 | free of charge | permission is @hereby granted free of charge to any person obtaining a copy of this software
mit | 0 | substantial portions | the above @copyright notice and this permission notice shall be included in all copies or substantial portions
mit | 1 | identifier mit | spdx @license identifier mit
mit | 1 | opensource | opensource org @licenses mit(?: license)?(?: php| html)?
mit | 2 | the mit | (?:released|distributed|available|licensed|published|provided) under (?:the )?(?:terms of the )?mit @license
mit | 2 | under | @licensed under (?:the )?mit
mit | 2 | expat | expat @license(?: mit)?
mit | 3 | mit | (?:the )?mit @license
mit | 3 | mit | (?:the )?mit @licence
mit | 3 | mit | @license mit
mit | 3 | mit | mit @licensed
mit-0 | 1 | identifier mit 0 | spdx @license identifier mit 0
mit-0 | 2 | mit no | mit no attribution @license
x11 | 2 | x11 | (?:the )?x11 @license
x11 | 0 | x consortium | name of the x consortium shall not be used in advertising(?: [^ ]+){0,20} @copyright
isc | 0 | with or without fee | permission to use copy modify and or distribute this software for any purpose with or without fee is @hereby granted
isc | 0 | isc disclaims | isc disclaims all @warranties with regard to this software
isc | 1 | identifier isc | spdx @license identifier isc
isc | 2 | isc | (?:released|distributed|licensed) under (?:the )?isc @license
isc | 3 | isc | (?:the )?isc @license
0bsd | 1 | identifier 0bsd | spdx @license identifier 0bsd
0bsd | 2 | zero clause | (?:bsd )?zero clause (?:bsd )?@license
bsd-4-clause | 0 | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment(?: [^ ]+){0,14} @copyright
bsd-4-clause | 1 | bsd 4 clause | spdx @license identifier bsd 4 clause
bsd-4-clause | 2 | clause | (?:4|four) clause bsd @license
bsd-4-clause | 2 | original bsd | original bsd @license
bsd-3-clause | 0 | endorse or promote | neither the names? of(?: [^ ]+){1,16} may be used to endorse or promote products derived from this software(?: [^ ]+){0,12} @copyright
bsd-3-clause | 1 | bsd 3 clause | spdx @license identifier bsd 3 clause
bsd-3-clause | 1 | bsd 3 clause | opensource org @licenses bsd 3 clause
bsd-3-clause | 2 | clause | (?:3|three) clause bsd @license
bsd-3-clause | 2 | bsd | (?:new|modified|revised) bsd @license
bsd-3-clause | 2 | bsd 3 clause | bsd 3 clause(?: new or revised)? @license
bsd-2-clause | 0 | binary form must reproduce | redistributions in binary form must reproduce the above @copyright notice this list of conditions
bsd-2-clause | 0 | source code must retain | redistributions of source code must retain the above @copyright notice this list of conditions
bsd-2-clause | 1 | bsd 2 clause | spdx @license identifier bsd 2 clause
bsd-2-clause | 1 | bsd 2 clause | opensource org @licenses bsd 2 clause
bsd-2-clause | 2 | clause | (?:2|two) clause bsd @license
bsd-2-clause | 2 | bsd | (?:simplified|freebsd) bsd @license
bsd | 0 | source and binary | @redistribution and use in source and binary forms with or without modification are permitted
bsd | 2 | bsd style | bsd style @license
bsd | 2 | under | @licensed under (?:the |a )?bsd
bsd | 3 | bsd | (?:the )?bsd @license
bsd | 3 | bsd | bsd @licensed
apache-2.0 | 0 | apache | @licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | 0 | as is | distributed under the license is distributed on an as is basis without @warranties or conditions of any kind
apache-2.0 | 0 | perpetual | each contributor @hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license
apache-2.0 | 1 | identifier apache 2 | spdx @license identifier apache 2 0
apache-2.0 | 1 | apache org | apache org @licenses license 2 0(?: txt| html)?
apache-2.0 | 1 | apache 2 0 | opensource org @licenses apache 2 0
apache-2.0 | 2 | apache | (?:the )?apache (?:software )?@license (?:version |v ?)?2(?: 0)?
apache-2.0 | 2 | apache | (?:the )?apache (?:software )?@license v2(?: 0)?
apache-2.0 | 2 | apache | apache (?:version )?2(?: 0)? @license
apache-2.0 | 2 | apache | apache (?:v2|asl2)(?: 0)? @license
apache-2.0 | 2 | asl 2 | @license asl 2 0
apache-1.1 | 1 | identifier apache 1 | spdx @license identifier apache 1 1
apache-1.1 | 2 | apache | (?:the )?apache (?:software )?@license (?:version |v ?)?1 1
apache-1.1 | 0 | apache software foundation | this product includes software developed by the apache software foundation(?: [^ ]+){0,20} @copyright
apache | 2 | under | @licensed under (?:the )?apache
apache | 3 | apache | (?:the )?apache (?:software )?@license
apache | 3 | apache | (?:the )?apache (?:software )?@licence
gpl-3.0-or-later | 1 | gpl 3 0 | spdx @license identifier gpl 3 0 or later
gpl-3.0-or-later | 0 | general public | gnu general public @license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl-3.0-or-later | 2 | gpl | @gplv3 or (?:any )?later
gpl-3.0 | 1 | gpl 3 0 | spdx @license identifier gpl 3 0(?: only)?
gpl-3.0 | 1 | gpl 3 0 | gnu org @licenses gpl 3 0(?: en)?(?: html| txt)?
gpl-3.0 | 0 | copyleft | the gnu general public license is a free @copyleft license for software and other kinds of works
gpl-3.0 | 2 | general public | (?:the )?gnu general public @license (?:version |v )3(?: 0)?
gpl-3.0 | 2 | general public | (?:the )?gnu general public @license v3(?: 0)?
gpl-3.0 | 2 | gpl | (?:gnu )?@gpl (?:version |v ?)?3(?: 0)?
gpl-3.0 | 2 | gplv3 | (?:gnu )?@gplv3
gpl-3.0 | 2 | gpl3 | (?:gnu )?@gpl3
gpl-2.0-or-later | 1 | gpl 2 0 | spdx @license identifier gpl 2 0 or later
gpl-2.0-or-later | 0 | general public | gnu general public @license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-2.0-or-later | 2 | gpl | @gplv2 or (?:any )?later
gpl-2.0 | 1 | gpl 2 0 | spdx @license identifier gpl 2 0(?: only)?
gpl-2.0 | 1 | gpl 2 0 | gnu org @licenses (?:old licenses )?gpl 2 0(?: html| txt)?
gpl-2.0 | 2 | general public | (?:the )?gnu general public @license (?:version |v )2(?: 0)?
gpl-2.0 | 2 | general public | (?:the )?gnu general public @license v2(?: 0)?
gpl-2.0 | 2 | gpl | (?:gnu )?@gpl (?:version |v ?)?2(?: 0)?
gpl-2.0 | 2 | gplv2 | (?:gnu )?@gplv2
gpl-2.0 | 2 | gpl2 | (?:gnu )?@gpl2
gpl-1.0 | 1 | gpl 1 0 | spdx @license identifier gpl 1 0(?: only| or later)?
gpl-1.0 | 2 | general public | (?:the )?gnu general public @license (?:version |v )1(?: 0)?
gpl-exception | 2 | classpath | (?:gnu )?@gpl (?:version )?(?:2 )?(?:0 )?with (?:the )?classpath exception
gpl-exception | 2 | exception | @gpl (?:[^ ]+ ){0,4}with (?:[^ ]+ ){0,4}linking exception
gpl | 0 | without even | without any warranty without even the implied @warranty of merchantability or fitness for a particular purpose see the gnu general public license
gpl | 0 | received a copy | you should have received a copy of the gnu general public @license along with this (?:program|software|file|library)
gpl | 1 | gnu org | gnu org @licenses gpl(?: html| txt)?
gpl | 2 | under | (?:released|distributed|available|licensed) under (?:the )?(?:terms of the )?(?:gnu )?@gpl
gpl | 3 | general public | (?:the )?(?:gnu )?general public @license
gpl | 3 | general public | (?:the )?(?:gnu )?general public @licence
gpl | 3 | gpl | (?:gnu )?@gpl
lgpl-3.0 | 1 | lgpl 3 0 | spdx @license identifier lgpl 3 0(?: only| or later)?
lgpl-3.0 | 1 | lgpl 3 0 | gnu org @licenses lgpl 3 0(?: en)?(?: html| txt)?
lgpl-3.0 | 2 | lesser general public | (?:the )?gnu lesser general public @license (?:version |v ?)?3(?: 0)?
lgpl-3.0 | 2 | lgpl | (?:gnu )?@lgpl (?:version |v ?)?3(?: 0)?
lgpl-3.0 | 2 | lgplv3 | (?:gnu )?@lgplv3
lgpl-2.1 | 1 | lgpl 2 1 | spdx @license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | 1 | lgpl 2 1 | gnu org @licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?
lgpl-2.1 | 2 | lesser general public | (?:the )?gnu lesser general public @license (?:version |v ?)?2 1
lgpl-2.1 | 2 | lgpl | (?:gnu )?@lgpl (?:version |v ?)?2 1
lgpl-2.0 | 1 | lgpl 2 0 | spdx @license identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | 2 | library general public | (?:the )?gnu library general public @license(?: (?:version |v ?)?2(?: 0)?)?
lgpl-2.0 | 2 | lgplv2 | (?:gnu )?@lgplv2
lgpl | 2 | lesser | (?:the )?(?:gnu )?lesser general public @license
lgpl | 3 | lgpl | (?:gnu )?@lgpl
agpl-3.0 | 1 | agpl 3 0 | spdx @license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 1 | agpl 3 0 | gnu org @licenses agpl 3 0(?: en)?(?: html| txt)?
agpl-3.0 | 2 | affero general public | (?:the )?gnu affero general public @license (?:version |v ?)?3(?: 0)?
agpl-3.0 | 2 | agplv3 | (?:gnu )?@agplv3
agpl-3.0 | 2 | agpl | (?:gnu )?@agpl (?:version |v ?)?3(?: 0)?
agpl | 2 | affero | (?:the )?(?:gnu )?affero general public @license
agpl | 3 | agpl | (?:gnu )?@agpl
gfdl | 0 | documentation | under the terms of the gnu free documentation @license version 1 [123]
gfdl | 1 | gfdl | spdx @license identifier gfdl 1 [123](?: only| or later)?
gfdl | 3 | free documentation | (?:the )?(?:gnu )?free documentation @license
mpl-2.0 | 0 | mozilla | this source code form is subject to the terms of the mozilla public @license v 2 0
mpl-2.0 | 1 | identifier mpl 2 | spdx @license identifier mpl 2 0
mpl-2.0 | 2 | mozilla public | (?:the )?mozilla public @license (?:version |v ?)?2(?: 0)?
mpl-1.1 | 1 | identifier mpl 1 | spdx @license identifier mpl 1 1
mpl-1.1 | 2 | mozilla public | (?:the )?mozilla public @license (?:version |v ?)?1 1
mpl-1.0 | 2 | mozilla public | (?:the )?mozilla public @license (?:version |v ?)?1 0
mpl | 3 | mozilla | (?:the )?mozilla public @license
npl | 2 | netscape | (?:the )?netscape public @license(?: version 1 [01])?
epl-2.0 | 1 | identifier epl 2 | spdx @license identifier epl 2 0
epl-2.0 | 2 | eclipse public | (?:the )?eclipse public @license (?:version |v ?)?2(?: 0)?
epl-1.0 | 1 | identifier epl 1 | spdx @license identifier epl 1 0
epl-1.0 | 2 | eclipse public | (?:the )?eclipse public @license (?:version |v ?)?1(?: 0)?
epl | 3 | eclipse | (?:the )?eclipse public @license
edl-1.0 | 2 | eclipse distribution | (?:the )?eclipse distribution @license(?: (?:version |v ?)?1 0)?
cddl-1.1 | 2 | common development | (?:the )?common development and distribution @license (?:version |v ?)?1 1
cddl-1.0 | 1 | cddl 1 0 | spdx @license identifier cddl 1 0
cddl-1.0 | 2 | common development | (?:the )?common development and distribution @license (?:version |v ?)?1 0
cddl | 3 | common development | (?:the )?common development and distribution @license
cddl | 3 | cddl | cddl @license
cpl-1.0 | 2 | common public | (?:the )?common public @license(?: (?:version |v ?)?1 0)?
ipl-1.0 | 2 | ibm public | (?:the )?ibm public @license(?: (?:version |v ?)?1 0)?
cpal-1.0 | 2 | common public attribution | (?:the )?common public attribution @license(?: (?:version |v ?)?1 0)?
cc0-1.0 | 1 | identifier cc0 | spdx @license identifier cc0 1 0
cc0-1.0 | 0 | public | dedicated (?:the |this )?(?:[^ ]+ ){0,12}to the public @domain (?:worldwide )?by waiving all of (?:his|her|their|its)
cc0-1.0 | 2 | cc0 | creative @commons (?:cc0|zero)(?: 1 0)?
cc0-1.0 | 2 | cc0 | @licensed under (?:a |the )?cc0(?: 1 0)?
cc0-1.0 | 2 | cc0 | cc0(?: 1 0)?(?: universal)? @license
cc-by-nc-nd | 1 | by nc nd | spdx @license identifier cc by nc nd [1234] 0
cc-by-nc-nd | 1 | by nc nd | creativecommons org @licenses by nc nd [1234] [05]
cc-by-nc-nd | 2 | noderiv | creative @commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?
cc-by-nc-nd | 2 | by nc nd | @licensed under (?:a |the )?(?:creative commons )?cc by nc nd(?: [1234] [05])?
cc-by-nc-nd | 2 | by nc nd | cc by nc nd(?: [1234] [05])? @license
cc-by-nc-sa | 1 | by nc sa | spdx @license identifier cc by nc sa [1234] 0
cc-by-nc-sa | 1 | by nc sa | creativecommons org @licenses by nc sa [1234] [05]
cc-by-nc-sa | 2 | share | creative @commons attribution non ?commercial share ?alike
cc-by-nc-sa | 2 | by nc sa | @licensed under (?:a |the )?(?:creative commons )?cc by nc sa(?: [1234] [05])?
cc-by-nc-sa | 2 | by nc sa | cc by nc sa(?: [1234] [05])? @license
cc-by-nc | 1 | by nc | spdx @license identifier cc by nc [1234] 0
cc-by-nc | 1 | by nc | creativecommons org @licenses by nc [1234] [05]
cc-by-nc | 2 | commercial | creative @commons attribution non ?commercial
cc-by-nc | 2 | by nc | @licensed under (?:a |the )?(?:creative commons )?cc by nc(?: [1234] [05])?
cc-by-nc | 2 | by nc | cc by nc(?: [1234] [05])? @license
cc-by-nd | 1 | by nd | spdx @license identifier cc by nd [1234] 0
cc-by-nd | 1 | by nd | creativecommons org @licenses by nd [1234] [05]
cc-by-nd | 2 | deriv | creative @commons attribution no ?deriv(?:ative)?s?(?: works)?
cc-by-nd | 2 | by nd | @licensed under (?:a |the )?(?:creative commons )?cc by nd(?: [1234] [05])?
cc-by-nd | 2 | by nd | cc by nd(?: [1234] [05])? @license
cc-by-sa | 1 | by sa | spdx @license identifier cc by sa [1234] 0
cc-by-sa | 1 | by sa | creativecommons org @licenses by sa [1234] [05]
cc-by-sa | 2 | share | creative @commons attribution share ?alike
cc-by-sa | 2 | by sa | @licensed under (?:a |the )?(?:creative commons )?cc by sa(?: [1234] [05])?
cc-by-sa | 2 | by sa | cc by sa(?: [1234] [05])? @license
cc-by | 1 | cc by | spdx @license identifier cc by [1234] 0
cc-by | 1 | creativecommons | creativecommons org @licenses by [1234] [05]
cc-by | 2 | attribution | creative @commons attribution(?: [1234] [05])?
cc-by | 2 | cc by | @licensed under (?:a |the )?(?:creative commons )?cc by(?: [1234] [05])?
cc-by | 2 | cc by | cc by(?: [1234] [05])? @license
cc | 3 | creative | creative @commons license
cc | 4 | creative | creative @commons
unlicense | 0 | public | this is free and unencumbered software released into the public @domain
unlicense | 1 | identifier unlicense | spdx @license identifier unlicense
unlicense | 2 | unlicense | (?:the )?@unlicense(?: org)?
wtfpl | 0 | want to public | do what the fuck you want to public @license
wtfpl | 3 | wtfpl | (?:the )?@wtfpl
zlib | 0 | no event | in no event will the authors be held liable for any damages arising from the use of this software(?: [^ ]+){0,24} @redistribution
zlib | 0 | express | this software is provided as is without any express or implied @warranty in no event will the authors be held liable
zlib | 1 | identifier zlib | spdx @license identifier zlib
zlib | 3 | zlib | (?:the )?zlib(?: libpng)? @license
libpng | 2 | libpng | (?:the )?libpng @license
bsl-1.0 | 0 | boost | boost software @license version 1 0
bsl-1.0 | 1 | identifier bsl | spdx @license identifier bsl 1 0
bsl-1.0 | 1 | boost org | boost org license 1 0(?: txt)?(?: [^ ]+){0,8} @copyright
bsl-1.0 | 3 | boost | (?:the )?boost (?:software )?@license
artistic-2.0 | 1 | artistic 2 | spdx @license identifier artistic 2 0
artistic-2.0 | 2 | artistic | (?:the )?artistic @license (?:version |v ?)?2(?: 0)?
artistic-1.0 | 1 | artistic 1 | spdx @license identifier artistic 1 0(?: perl)?
artistic-1.0 | 2 | artistic | (?:the )?artistic @license (?:version |v ?)?1(?: 0)?
artistic | 3 | artistic | (?:the )?(?:perl )?artistic @license
psf-2.0 | 1 | identifier p | spdx @license identifier (?:psf|python) 2 0
psf-2.0 | 2 | python software foundation | (?:the )?python software foundation @license(?: version 2)?
psf-2.0 | 3 | python | (?:the )?(?:python|psf) @license
php-3.01 | 2 | php | (?:the )?php @license(?: (?:version |v ?)?3 0 ?1?)?
ruby | 3 | ruby | (?:the )?ruby(?: s)? @license
perl | 2 | perl | under the same (?:terms|license) as perl(?: itself)?(?: [^ ]+){0,12} @copyright
openssl | 2 | openssl | (?:the )?openssl (?:and ssleay )?@license
ncsa | 2 | ncsa | (?:the )?(?:university of illinois )?ncsa (?:open source )?@license
ecl-2.0 | 2 | educational community | (?:the )?educational community @license(?: (?:version |v ?)?2 0)?
afl-3.0 | 2 | academic free | (?:the )?academic free @license(?: (?:version |v ?)?3 0)?
osl-3.0 | 2 | open software | (?:the )?open software @license(?: (?:version |v ?)?3 0)?
eupl-1.2 | 1 | eupl | spdx @license identifier eupl 1 [12]
eupl-1.2 | 2 | european union public | (?:the )?european union public @licen[cs]e(?: (?:version |v ?)?1 2)?
ofl-1.1 | 1 | ofl | spdx @license identifier ofl 1 1
ofl-1.1 | 2 | sil open font | (?:the )?sil open font @license(?: (?:version |v ?)?1 1)?
ofl-1.1 | 3 | open font | (?:the )?open font @license
ms-pl | 2 | microsoft public | (?:the )?microsoft public @license(?: ms pl)?
ms-rl | 2 | microsoft reciprocal | (?:the )?microsoft reciprocal @license(?: ms rl)?
upl-1.0 | 2 | universal permissive | (?:the )?universal permissive @license(?: (?:version |v ?)?1 0)?
cecill-2.1 | 2 | cecill | (?:the )?cecill(?: [bc])?(?: (?:version |v ?)?2(?: [01])?)? @license
mulanpsl-2.0 | 2 | mulan | (?:the )?mulan (?:permissive software|psl)(?: v2)? @license(?: (?:version |v ?)?2)?
postgresql | 2 | postgresql | (?:the )?postgresql @license
curl | 2 | curl | (?:the )?curl @license
vim | 2 | vim | (?:the )?vim @license
w3c | 2 | w3c | (?:the )?w3c (?:software )?(?:notice and )?@license
unicode | 2 | unicode | (?:the )?unicode (?:inc )?@license(?: agreement)?
zpl-2.1 | 2 | zope | (?:the )?zope public @license(?: (?:version |v ?)?2 [01])?
qpl-1.0 | 2 | q public | (?:the )?q public @license(?: (?:version |v ?)?1 0)?
sleepycat | 2 | sleepycat | (?:the )?sleepycat @license
lppl-1.3c | 2 | latex project | (?:the )?latex project public @license(?: (?:version |v ?)?1 3 ?[abc]?)?
rpl-1.5 | 2 | reciprocal public | (?:the )?reciprocal public @license(?: (?:version |v ?)?1 5)?
nasa-1.3 | 2 | nasa | (?:the )?nasa open source agreement(?: [^ ]+){0,6} @license
bsd-protection | 2 | protection | bsd protection @license
beerware | 2 | beer | (?:the )?beer ware @license
beerware | 3 | beerware | (?:the )?@beerware
json | 0 | evil | the software shall be used for good not evil(?: [^ ]+){0,8} @warranty
json | 3 | json | (?:the )?json @license
odbl-1.0 | 1 | odbl | spdx @license identifier odbl 1 0
odbl-1.0 | 2 | open database | (?:the )?(?:open data commons )?open database @license(?: odbl)?
odc-by-1.0 | 2 | open data | open data @commons attribution(?: license)?
pddl-1.0 | 2 | dedication | (?:open data commons )?public @domain dedication and license
ogl-uk-3.0 | 2 | open government | (?:the )?open government @licence(?: (?:version |v ?)?[123] 0)?
etalab-2.0 | 2 | licence ouverte | @licence ouverte(?: open licence)?(?: (?:version |v ?)?2 0)?
sspl-1.0 | 1 | sspl | spdx @license identifier sspl 1 0
sspl-1.0 | 2 | server side public | (?:the )?server side public @license(?: (?:version |v ?)?1)?
busl-1.1 | 1 | busl | spdx @license identifier busl 1 1
busl-1.1 | 2 | business source | (?:the )?business source @license(?: (?:version |v ?)?1 1)?
elastic-2.0 | 2 | elastic | (?:the )?elastic @license(?: (?:version |v ?)?2(?: 0)?)?
commons-clause | 2 | clause | @commons clause(?: license condition)?
polyform | 2 | polyform | (?:the )?polyform (?:noncommercial|shield|strict|perimeter|internal use|small business) @license
openrail | 2 | rail | (?:the )?(?:creativeml |bigscience )?(?:open ?)?rail(?: m)? @license
llama | 2 | llama | (?:the )?llama ?[23]?(?: [0-9])? community @license(?: agreement)?
gemma | 2 | gemma | gemma (?:terms of use|@license)
public-domain | 2 | public | (?:released|placed|dedicated) (?:in|into|to) the public @domain
public-domain | 3 | public | (?:is |are )?in the public @domain
public-domain | 4 | public | public @domain
proprietary | 2 | proprietary | proprietary and confidential(?: [^ ]+){0,10} rights @reserved
proprietary | 2 | unauthorized | all rights @reserved unauthorized (?:copying|reproduction|use)
proprietary | 2 | end user | end user @license agreement
proprietary | 2 | commercial | (?:under a |requires a )?commercial @license
proprietary | 3 | proprietary | proprietary @license
all-rights-reserved | 2 | copyright | @copyright(?: c)?(?: [12][0-9]{3}){1,4}(?: [^ ]+){1,8} all rights reserved
all-rights-reserved | 3 | all rights | all rights @reserved
copyright | 3 | copyright | @copyright(?: c)?(?: by)?(?: [12][0-9]{3}){1,4}
copyright | 4 | copyright | @copyright(?: c)? (?:holders?|owners?|notice)
copyleft | 4 | copyleft | @copyleft
no-warranty | 3 | warrant | without (?:any )?@warranty(?: of any kind)?
no-warranty | 3 | warrant | without @warranties or conditions of any kind
no-warranty | 3 | merchantability | implied @warranties of merchantability(?: and fitness for a particular purpose)?
see-license | 3 | see | see (?:the )?@license(?: file| txt| md)?(?: for (?:details|more information))?
dual-licensed | 3 | dual | dual @licensed
dual-licensed | 3 | dual | (?:under a )?dual @license
open-source | 4 | open source | open source @license
free-software | 4 | free software | free software @license
unknown-license | 4 | under | @licensed under(?: the| a| an)?(?: [^ ]+){1,4}
unknown-license | 4 | license | (?:under|of|by) (?:the |this |its |a )?(?:following )?@license(?: agreement)?
"""


def rules() -> list[tuple[int, int, str, str, str, str]]:
    """(rank, tier, label, anchor, keyword, pattern) of every signature; the pattern takes a space on either side."""
    out = []
    for line in SIGNATURES.strip().splitlines():
        label, tier, keyword, pattern = (x.strip() for x in line.split("|", 3))
        at = pattern.index("@") + 1
        stop = next((i for i in range(at, len(pattern)) if not (pattern[i].isalnum() or pattern[i] in "[]")), len(pattern))
        word = pattern[at:stop]
        anchors = [word] if "[" not in word else [word.replace("[cs]", c) for c in "cs"]
        for anchor in anchors:
            out.append((len(out), int(tier), label, anchor, keyword, f" (?:{pattern.replace(word, anchor, 1) if '[' in word else pattern}) "))
    return out
