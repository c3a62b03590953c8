"""Hand-written license signatures over normalised words: lower case, single spaces, no punctuation.

A line is ``label | priority | keyword | pattern``. Patterns match whole words (the caller adds the borders). Priority
5 names a license with its version or quotes its text, 1 is a mere hint. The keyword must occur in a text for the pattern
to be tried: a word of all its wordings, or ("deal") one that the license has elsewhere and its kin lack. Every pattern
holds one of the words of GATE.
"""

#: Any license text has one of these; documents without them are not normalised at all.
GATE = ["license", "licence", "licensed", "copyright", "copyleft", "cc", "domain", "warranty", "spdx", "permission", "redistribution", "unlicense"]

_RULES = r"""
apache-2.0 | 5 | apache | apache license (?:version )?2(?: 0)?
apache-2.0 | 5 | apache | apache 2(?: 0)? license
apache-2.0 | 5 | apl | apl 2(?: 0)? license
apache-2.0 | 5 | asl | asl 2(?: 0)? license
apache-2.0 | 5 | apache | spdx license identifier apache 2 0
apache-2.0 | 5 | apache | www apache org licenses license 2 0
apache-1.1 | 5 | apache | apache (?:software )?license (?:version )?1 1
apache-1.0 | 5 | apache | apache (?:software )?license (?:version )?1 0
apache | 3 | apache | apache (?:software )?licen[cs]e
apache | 2 | apache | licensed to the apache software foundation
gpl-3.0 | 5 | gnu | gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version |v)3
gpl-3.0 | 5 | gnu | gnu gpl (?:version |v)?3 license
gpl-3.0 | 5 | gpl | spdx license identifier gpl 3 0(?: only| or later)?
gpl-2.0 | 5 | gnu | gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version |v)2
gpl-2.0 | 5 | gpl | spdx license identifier gpl 2 0(?: only| or later)?
gpl-2.0 | 5 | gpl | gpl (?:version |v)?2(?: 0)? licensed?
gpl-1.0 | 5 | gnu | gnu general public license (?:version |v)1
gpl | 3 | gnu | gnu general public licen[cs]e
gpl | 3 | gpl | gnu gpl licen[cs]e
gpl | 2 | gpl | licensed under the (?:gnu )?gpl
gpl | 2 | gpl | gpl licensed
gpl-3.0 | 5 | gpl | licensed under (?:the )?(?:gnu )?gpl v?3(?: 0)?
gpl-3.0 | 5 | gpl3 | licensed under (?:the )?(?:gnu )?gpl3(?: 0)?
gpl-3.0 | 5 | gplv3 | licensed under (?:the )?(?:gnu )?gplv3(?: 0)?
gpl-2.0 | 5 | gplv2 | licensed under (?:the )?(?:gnu )?gplv2
lgpl-3.0 | 5 | lesser | gnu lesser general public license (?:as published by the free software foundation )?(?:either )?(?:version |v)3
lgpl-2.1 | 5 | lesser | gnu lesser general public license (?:as published by the free software foundation )?(?:either )?(?:version |v)2 1
lgpl-2.0 | 5 | library | gnu library general public license (?:as published by the free software foundation )?(?:either )?(?:version |v)2
lgpl | 3 | lesser | (?:gnu )?lesser general public licen[cs]e
lgpl | 3 | library | gnu library general public licen[cs]e
lgpl-2.1 | 5 | lgpl | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 5 | lgpl | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl | 2 | lgpl | licensed under (?:the )?(?:gnu )?lgpl
agpl-3.0 | 5 | affero | gnu affero general public license (?:as published by the free software foundation )?(?:either )?(?:version |v)3
agpl | 3 | affero | (?:gnu )?affero general public licen[cs]e
agpl-3.0 | 5 | agpl | spdx license identifier agpl 3 0(?: only| or later)?
agpl | 2 | agpl | licensed under (?:the )?(?:gnu )?agpl
gfdl-1.3 | 5 | gnu | gnu free documentation license (?:version |v)1 3
gfdl-1.2 | 5 | gnu | gnu free documentation license (?:version |v)1 2
gfdl-1.1 | 5 | gnu | gnu free documentation license (?:version |v)1 1
gfdl | 3 | gnu | gnu free documentation licen[cs]e
gpl-classpath | 4 | classpath | gnu general public license .{0,40}classpath exception
gpl-notice | 2 | gnu | you should have received a copy of the gnu (?:lesser |affero )?general public license
gpl-notice | 2 | fitness | without even the implied warranty of merchantability or fitness
mit | 5 | mit | (?:the )?mit license
mit | 5 | mit | spdx license identifier mit
mit | 4 | mit | licensed under (?:the )?mit
mit | 4 | mit | mit licensed
mit | 4 | mit | license mit
mit | 5 | expat | expat license
mit | 4 | deal | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 4 | deal | copyright notice and this permission notice shall be included in all copies
mit-0 | 5 | mit | mit no attribution license
mit-0 | 5 | mit | spdx license identifier mit 0
x11 | 5 | x11 | x11 license
x11 | 4 | consortium | copyright .{0,20}x consortium
isc | 5 | isc | (?:the )?isc license
isc | 5 | isc | spdx license identifier isc
isc | 4 | purpose | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee
0bsd | 5 | bsd | zero clause bsd license
0bsd | 5 | 0bsd | spdx license identifier 0bsd
bsd-2-clause | 5 | bsd | (?:simplified|freebsd) bsd license
bsd-2-clause | 5 | bsd | (?:2|two) clause bsd license
bsd-2-clause | 5 | bsd | bsd 2 clause(?: simplified)? license
bsd-2-clause | 5 | bsd | spdx license identifier bsd 2 clause
bsd-3-clause | 5 | bsd | (?:new|modified|revised) bsd license
bsd-3-clause | 5 | bsd | (?:3|three) clause bsd license
bsd-3-clause | 5 | bsd | bsd 3 clause(?: new)? license
bsd-3-clause | 5 | bsd | spdx license identifier bsd 3 clause
bsd-3-clause | 3 | endorse | endorse or promote products .{0,60}without specific prior written permission
bsd-4-clause | 5 | bsd | (?:original|old) bsd license
bsd-4-clause | 5 | bsd | (?:4|four) clause bsd license
bsd-4-clause | 5 | bsd | spdx license identifier bsd 4 clause
bsd | 3 | bsd | bsd(?: style)? licen[cs]e
bsd | 2 | bsd | bsd licensed
bsd | 3 | binary | redistribution and use in source and binary forms
mpl-2.0 | 5 | mozilla | mozilla public license (?:version |v)?2 0
mpl-1.1 | 5 | mozilla | mozilla public license (?:version |v)?1 1
mpl-1.0 | 5 | mozilla | mozilla public license (?:version |v)?1 0
mpl-2.0 | 5 | mpl | spdx license identifier mpl 2 0
mpl | 3 | mozilla | mozilla public licen[cs]e
mpl | 2 | mpl | licensed under (?:the )?mpl
npl-1.1 | 5 | netscape | netscape public license (?:version |v)?1 1
npl | 3 | netscape | netscape public licen[cs]e
epl-2.0 | 5 | eclipse | eclipse public license (?:version |v)?2(?: 0)?
epl-1.0 | 5 | eclipse | eclipse public license (?:version |v)?1(?: 0)?
epl-2.0 | 5 | epl | spdx license identifier epl 2 0
epl | 3 | eclipse | eclipse public licen[cs]e
edl-1.0 | 5 | eclipse | eclipse distribution license(?: version| v)?(?: 1 0)?
cddl-1.0 | 5 | common | common development and distribution license (?:version |v)?1 0
cddl-1.1 | 5 | common | common development and distribution license (?:version |v)?1 1
cddl | 3 | common | common development and distribution licen[cs]e
cpl-1.0 | 5 | common | common public license(?: version| v)? 1 0
cpl | 3 | common | common public licen[cs]e
cpal-1.0 | 5 | attribution | common public attribution license
ipl-1.0 | 5 | ibm | ibm public license
eupl-1.2 | 5 | european | european union public licen[cs]e (?:version |v)?1 2
eupl-1.1 | 5 | european | european union public licen[cs]e (?:version |v)?1 1
eupl | 3 | european | european union public licen[cs]e
cecill-2.1 | 5 | cecill | cecill (?:free software )?license (?:agreement )?(?:version |v)?2 1
cecill-b | 5 | cecill | cecill b (?:free software )?license
cecill-c | 5 | cecill | cecill c (?:free software )?license
cecill | 3 | cecill | cecill (?:free software )?license
osl-3.0 | 5 | open | open software license (?:version |v)?3 0
osl | 3 | open | open software licen[cs]e
afl-3.0 | 5 | academic | academic free license (?:version |v)?3 0
afl-2.1 | 5 | academic | academic free license (?:version |v)?2 1
afl | 3 | academic | academic free licen[cs]e
ecl-2.0 | 5 | educational | educational community license
artistic-2.0 | 5 | artistic | artistic license (?:version |v)?2(?: 0)?
artistic-1.0 | 5 | artistic | artistic license (?:version |v)?1(?: 0)?
artistic | 3 | artistic | (?:the )?(?:perl )?artistic licen[cs]e
perl | 4 | perl | (?:license|licensed|copyright) .{0,40}same terms as perl itself
python-2.0 | 5 | python | python license (?:version )?2(?: 0)?
psf-2.0 | 5 | python | python software foundation license(?: version 2)?
cnri-python | 5 | cnri | cnri (?:open source )?(?:python )?license
ruby | 5 | ruby | ruby license
php-3.01 | 5 | php | php license (?:version |v)?3 01
php-3.0 | 5 | php | php license (?:version |v)?3 0
php | 3 | php | php licen[cs]e
zend-2.0 | 5 | zend | zend (?:engine )?license
postgresql | 5 | postgresql | postgresql licen[cs]e
sqlite-blessing | 5 | sqlite | sqlite .{0,30}public domain
sleepycat | 5 | sleepycat | sleepycat (?:public )?license
berkeley-db | 4 | berkeley | berkeley (?:db|database) license
openssl | 5 | openssl | openssl license
ssleay | 5 | ssleay | ssleay license
zlib | 5 | zlib | zlib(?: libpng)? license
zlib | 5 | zlib | spdx license identifier zlib
libpng | 5 | libpng | libpng license
libtiff | 5 | libtiff | libtiff license
ijg | 5 | jpeg | independent jpeg group .{0,30}license
bzip2 | 5 | bzip2 | bzip2 license
curl | 5 | curl | curl license
boost-1.0 | 5 | boost | boost software license(?: version| v)?(?: 1 0)?
boost-1.0 | 5 | bsl | spdx license identifier bsl 1 0
ncsa | 5 | ncsa | (?:university of illinois )?ncsa (?:open source )?license
uoi-ncsa | 4 | illinois | university of illinois .{0,20}open source license
w3c | 5 | w3c | w3c software (?:notice )?(?:and )?license
w3c-document | 5 | w3c | w3c document license
unicode | 5 | unicode | unicode (?:inc )?license agreement
icu | 5 | icu | icu license
wtfpl | 5 | fuck | do what the fuck you want to public license
wtfpl | 5 | wtfpl | wtfpl license
beerware | 5 | beer | beer ware license
beerware | 5 | beerware | beerware license
unlicense | 5 | unlicense | (?:the )?unlicense
unlicense | 4 | unencumbered | free and unencumbered software released into the public domain
unlicense | 5 | unlicense | spdx license identifier unlicense
cc0-1.0 | 5 | cc0 | cc0(?: 1 0)?(?: universal)? (?:license|licence|public domain)
cc0-1.0 | 5 | zero | creative commons (?:cc )?zero .{0,20}license
cc0-1.0 | 5 | cc0 | spdx license identifier cc0 1 0
cc-by-4.0 | 5 | cc | cc by 4 0
cc-by-3.0 | 5 | cc | cc by 3 0
cc-by-2.5 | 5 | cc | cc by 2 5
cc-by-2.0 | 5 | cc | cc by 2 0
cc-by-1.0 | 5 | cc | cc by 1 0
cc-by-sa-4.0 | 5 | cc | cc by sa 4 0
cc-by-sa-3.0 | 5 | cc | cc by sa 3 0
cc-by-sa-2.5 | 5 | cc | cc by sa 2 5
cc-by-sa-2.0 | 5 | cc | cc by sa 2 0
cc-by-nc-4.0 | 5 | cc | cc by nc 4 0
cc-by-nc-3.0 | 5 | cc | cc by nc 3 0
cc-by-nc-2.0 | 5 | cc | cc by nc 2 0
cc-by-nd-4.0 | 5 | cc | cc by nd 4 0
cc-by-nd-3.0 | 5 | cc | cc by nd 3 0
cc-by-nc-sa-4.0 | 5 | cc | cc by nc sa 4 0
cc-by-nc-sa-3.0 | 5 | cc | cc by nc sa 3 0
cc-by-nc-sa-2.0 | 5 | cc | cc by nc sa 2 0
cc-by-nc-nd-4.0 | 5 | cc | cc by nc nd 4 0
cc-by-nc-nd-3.0 | 5 | cc | cc by nc nd 3 0
cc-by-nc-nd-2.0 | 5 | cc | cc by nc nd 2 0
cc-by-nc-nd | 4 | cc | cc by nc nd
cc-by-nc-sa | 4 | cc | cc by nc sa
cc-by-nc | 3 | cc | cc by nc
cc-by-nd | 3 | cc | cc by nd
cc-by-sa | 3 | cc | cc by sa
cc-by | 2 | cc | cc by
cc-by-4.0 | 5 | attribution | creative commons attribution 4 0 (?:international )?licen[cs]e
cc-by-3.0 | 5 | attribution | creative commons attribution 3 0 (?:unported )?licen[cs]e
cc-by-2.0 | 5 | attribution | creative commons attribution 2 0 (?:generic )?licen[cs]e
cc-by-sa-4.0 | 5 | attribution | creative commons attribution share ?alike 4 0 (?:international )?licen[cs]e
cc-by-sa-3.0 | 5 | attribution | creative commons attribution share ?alike 3 0 (?:unported )?licen[cs]e
cc-by-nc-4.0 | 5 | attribution | creative commons attribution non ?commercial 4 0 (?:international )?licen[cs]e
cc-by-nc-sa-4.0 | 5 | attribution | creative commons attribution non ?commercial share ?alike 4 0 (?:international )?licen[cs]e
cc-by-nc-nd-4.0 | 5 | attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0 (?:international )?licen[cs]e
cc-by-nd-4.0 | 5 | attribution | creative commons attribution no ?deriv(?:ative)?s 4 0 (?:international )?licen[cs]e
cc-by-nc-sa | 4 | attribution | creative commons attribution non ?commercial share ?alike licen[cs]e
cc-by-nc | 4 | attribution | creative commons attribution non ?commercial licen[cs]e
cc-by-sa | 4 | attribution | creative commons attribution share ?alike licen[cs]e
cc-by | 3 | attribution | creative commons attribution licen[cs]e
creative-commons | 2 | creative | creative commons licen[cs]e
creative-commons | 2 | creative | licensed under (?:a )?creative commons
public-domain | 4 | domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 2 | domain | (?:is )?in the public domain
pddl-1.0 | 5 | dedication | (?:odc )?public domain dedication and licen[cs]e
odbl-1.0 | 5 | database | open (?:data commons open )?database licen[cs]e
odc-by-1.0 | 5 | commons | open data commons attribution licen[cs]e
ogl-3.0 | 5 | government | open government licen[cs]e (?:version |v)?3 0
ogl | 3 | government | open government licen[cs]e
etalab-2.0 | 5 | etalab | etalab (?:open )?licen[cs]e
ofl-1.1 | 5 | font | sil open font licen[cs]e(?: version| v)?(?: 1 1)?
ofl | 3 | font | open font licen[cs]e
ubuntu-font | 5 | ubuntu | ubuntu font licen[cs]e
bitstream-vera | 5 | bitstream | bitstream vera .{0,20}(?:license|copyright)
lppl-1.3c | 5 | latex | latex project public license (?:version |v)?1 3c
lppl | 3 | latex | latex project public licen[cs]e
qpl-1.0 | 5 | q | q public license
sspl-1.0 | 5 | server | server side public license
busl-1.1 | 5 | business | business source license(?: version| v)?(?: 1 1)?
elastic-2.0 | 5 | elastic | elastic license(?: version| v)?(?: 2 0)?
commons-clause | 4 | clause | commons clause license
polyform-nc | 5 | polyform | polyform noncommercial license
polyform | 3 | polyform | polyform (?:[a-z]+ )?license
confluent | 5 | confluent | confluent community license
timescale | 5 | timescale | timescale license
redis-sal | 5 | redis | redis source available license
openrail | 4 | openrail | (?:creativeml |bigscience |bigcode )?openrail(?: m)? license
openrail | 4 | rail | (?:bigscience |bigcode )?open rail license
llama-community | 5 | llama | llama (?:2|3|3 1|3 2|4)? ?community license
ms-pl | 5 | microsoft | microsoft public license
ms-rl | 5 | microsoft | microsoft reciprocal license
ms-lpl | 5 | microsoft | microsoft limited public license
apsl-2.0 | 5 | apple | apple public source license(?: version| v)?(?: 2 0)?
aladdin | 5 | aladdin | aladdin free public license
sun-sissl | 5 | sun | sun industry standards source license
oracle-upl-1.0 | 5 | universal | universal permissive license
nokia | 5 | nokia | nokia open source license
motosoto | 5 | motosoto | motosoto open source license
intel | 4 | intel | intel open source license
nasa-1.3 | 5 | nasa | nasa open source agreement .{0,20}license
eiffel | 4 | eiffel | eiffel forum license
entessa | 5 | entessa | entessa public license
fair | 4 | fair | fair license
frameworx | 5 | frameworx | frameworx open license
hpnd | 5 | historical | historical permission notice and disclaimer
jabber | 5 | jabber | jabber open source license
lucent-1.02 | 5 | lucent | lucent public license(?: version| v)?(?: 1 02)?
miros | 5 | miros | miros licen[cs]e
mulan-2.0 | 5 | mulan | mulan permissive software license(?: version| v)?(?: 2)?
naumen | 5 | naumen | naumen public license
ogtsl | 5 | group | open group test suite license
rpl-1.5 | 5 | reciprocal | reciprocal public license(?: version| v)?(?: 1 5)?
rscpl | 5 | ricoh | ricoh source code public license
simpl-2.0 | 5 | simple | simple public license
vsl-1.0 | 5 | vovida | vovida software license
watcom | 5 | watcom | sybase open watcom public license
wxwindows | 5 | wxwindows | wxwindows library licen[cs]e
xnet | 5 | x | x net license
zpl-2.1 | 5 | zope | zope public license(?: version| v)?(?: 2 1)?
zpl | 3 | zope | zope public licen[cs]e
tcl | 5 | tcl | tcl(?: tk)? license
vim | 5 | vim | vim license
info-zip | 5 | zip | info zip license
freetype | 5 | freetype | freetype (?:project )?license
imagemagick | 5 | imagemagick | imagemagick license
json | 5 | json | json license
json | 4 | evil | license .{0,60}shall be used for good not evil
hippocratic | 5 | hippocratic | hippocratic license
jython | 5 | jython | jython license
afmparse | 3 | metric | font metric .{0,30}copyright
proprietary | 3 | reserved | copyright .{0,60}all rights reserved
proprietary | 3 | proprietary | proprietary licen[cs]e
commercial | 3 | commercial | commercial licen[cs]e
eula | 3 | user | end user licen[cs]e agreement
shareware | 3 | shareware | shareware licen[cs]e
freeware | 3 | freeware | freeware licen[cs]e
copyleft | 1 | copyleft | copyleft licen[cs]e
open-source | 1 | open | open source licen[cs]e
"""

#: (label, priority, keyword, pattern), in the order in which ties are resolved.
RULES = [(a, int(b), c, d) for a, b, c, d in (tuple(map(str.strip, line.split(" | "))) for line in _RULES.strip().splitlines())]
