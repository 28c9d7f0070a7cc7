"""Signatures of licences: hand-written rules, in order of priority.

A line is ``label ~ keyword ~ pattern``. Patterns see a text as its lower-cased
words with one blank between them, so punctuation is gone: "Apache-2.0" reads
``apache 2 0``. A pattern covers whole words, and every match holds the keyword
as a word of its own; ``a|b`` names words of which it holds one. Rules of an
earlier tier, and within a tier earlier rules, suppress what later rules find
inside their matches.
"""

#: Sentences of licence texts and of the headers that projects put into files.
TEXTS = r"""
mit ~ sublicense ~ permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
x11 ~ consortium ~ except as contained in this notice the name of the x consortium shall not be used in advertising
mit-0 ~ hereby ~ permission is hereby granted free of charge to any person obtaining a copy of this software (?:\S+ ){20,60}furnished to do so the software is provided as is
mit ~ hereby ~ permission is hereby granted free of charge to any person obtaining a copy
isc ~ fee ~ permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd ~ fee ~ permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd ~ fee ~ permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
ntp ~ fee ~ permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
bsd-4-clause ~ advertising ~ all advertising materials mentioning features or use of this software must display
bsd-3-clause ~ neither ~ neither the name of (?:\S+ ){1,12}nor the names of (?:its|their|the|his) (?:\S+ )?contributors may be used to endorse or promote products
bsd-3-clause ~ endorse ~ the names? of (?:\S+ ){1,12}may not be used to endorse or promote products
bsd-2-clause ~ redistributions ~ redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd-2-clause ~ redistribution ~ redistribution and use in source and binary forms with or without modification are permitted
bsd-source-code ~ redistributions ~ redistributions of source code must retain the above copyright notice
apache-2.0 ~ perpetual ~ each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-2.0 ~ compliance ~ you may not use this file except in compliance with the license you may obtain a copy of the license at http s? ?www apache org licenses license 2 0
apache-2.0 ~ compliance ~ you may not use this file except in compliance with the license
apache-1.1 ~ foundation ~ this product includes software developed by the apache software foundation
agpl-3.0-or-later ~ affero ~ (?:under|of) the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3.0-only ~ affero ~ (?:under|of) the terms of the gnu affero general public license version 3(?: 0)? as published by the free software foundation
agpl-3.0 ~ affero ~ gnu affero general public license version 3 19 november 2007
lgpl-3.0-or-later ~ lesser ~ (?:under|of) the terms of the gnu lesser general public license as published by the free software foundation either version 3(?: 0)? of the license or at your option any later version
lgpl-2.1-or-later ~ lesser ~ (?:under|of) the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-2.0-or-later ~ library ~ (?:under|of) the terms of the gnu library general public license as published by the free software foundation either version 2(?: 0)? of the license or at your option any later version
lgpl-2.1-only ~ lesser ~ (?:under|of) the terms of the gnu lesser general public license version 2 1 as published by the free software foundation
lgpl-3.0-only ~ lesser ~ (?:under|of) the terms of the gnu lesser general public license version 3(?: 0)? as published by the free software foundation
gpl-3.0-or-later ~ gnu ~ (?:under|of) the terms of the gnu general public license as published by the free software foundation either version 3(?: 0)? of the license or at your option any later version
gpl-2.0-or-later ~ gnu ~ (?:under|of) the terms of the gnu general public license as published by the free software foundation either version 2(?: 0)? of the license or at your option any later version
gpl-1.0-or-later ~ gnu ~ (?:under|of) the terms of the gnu general public license as published by the free software foundation either version 1(?: 0)? (?:of the license )?or at your option any later version
gpl-2.0-only ~ gnu ~ (?:under|of) the terms of the gnu general public license version 2(?: 0)? as published by the free software foundation
gpl-3.0-only ~ gnu ~ (?:under|of) the terms of the gnu general public license version 3(?: 0)? as published by the free software foundation
gpl-3.0 ~ gnu ~ gnu general public license version 3 29 june 2007
gpl-2.0 ~ gnu ~ gnu general public license version 2 june 1991
lgpl-3.0 ~ lesser ~ gnu lesser general public license version 3 29 june 2007
lgpl-2.1 ~ lesser ~ gnu lesser general public license version 2 1 february 1999
gfdl-1.3-or-later ~ documentation ~ under the terms of the gnu free documentation license version 1 3 or any later version
gfdl-1.2-or-later ~ documentation ~ under the terms of the gnu free documentation license version 1 2 or any later version
gfdl-1.1-or-later ~ documentation ~ under the terms of the gnu free documentation license version 1 1 or any later version
mpl-2.0 ~ mozilla ~ this source code form is subject to the terms of the mozilla public license v ?2 0
mpl-1.1 ~ mozilla ~ the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 ~ mozilla ~ the contents of this file are subject to the mozilla public license version 1 0
npl-1.1 ~ netscape ~ the contents of this file are subject to the netscape public license version 1 1
cddl-1.0 ~ distribution ~ the contents of this file are subject to the terms of the common development and distribution license
epl-2.0 ~ eclipse ~ this program and the accompanying materials are made available under the terms of the eclipse public license (?:v ?)?2 0
epl-1.0 ~ eclipse ~ this program and the accompanying materials are made available under the terms of the eclipse public license v ?1 0
zlib ~ misrepresented ~ altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib ~ misrepresented ~ the origin of this software must not be misrepresented
bsl-1.0 ~ organization ~ permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
unlicense ~ unencumbered ~ this is free and unencumbered software released into the public domain
wtfpl ~ fuck ~ you just do what the fuck you want to
cc0-1.0 ~ waives ~ (?:affirmer )?hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders
cc0-1.0 ~ waived ~ (?:has|have) waived all copyright and related or neighboring rights
artistic-2.0 ~ establishes ~ everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes the terms
ofl-1.1 ~ font ~ this font software is licensed under the sil open font license version 1 1
postgresql ~ postgresql ~ postgresql database management system formerly known as postgres
python-2.0 ~ psf ~ psf is making python available to licensee on an as is basis
openssl ~ openssl ~ this product includes software developed by the openssl project for use in the openssl toolkit
ssleay ~ eric ~ this product includes cryptographic software written by eric young
php-3.01 ~ php ~ this product includes php software freely available from
curl ~ stenberg ~ copyright c (?:\S+ ){1,4}daniel stenberg
beerware ~ beer ~ (?:you can |can )?buy me a beer in return
json ~ evil ~ the software shall be used for good not evil
ms-pl ~ microsoft ~ this license governs use of the accompanying software (?:\S+ ){0,40}microsoft
eupl-1.2 ~ eupl ~ licensed under the eupl version 1 2
eupl-1.1 ~ eupl ~ licensed under the eupl version 1 1
elastic-2.0 ~ elastic ~ licensed under the elastic license 2 0
sspl-1.0 ~ server ~ under the terms of the server side public license version 1
busl-1.1 ~ licensor ~ the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
commons-clause ~ sell ~ the license does not grant to you the right to sell the software
icu ~ unicode ~ copyright c 1991 \d{4} unicode inc all rights reserved
w3c ~ w3c ~ permission to copy modify and distribute this (?:software|work) (?:\S+ ){1,40}w3c
hippocratic ~ hippocratic ~ (?:licensed )?under the hippocratic license
blueoak-1.0.0 ~ blue ~ blue oak model license 1 0 0
mulan-2.0 ~ mulan ~ licensed under mulan psl v2
upl-1.0 ~ universal ~ licensed under the universal permissive license v ?1 0
"""

#: Identifiers of the SPDX list after their tag.
TAGS = r"""
agpl-3.0-or-later ~ agpl ~ spdx license identifier agpl 3 0 or later
agpl-3.0-only ~ agpl ~ spdx license identifier agpl 3 0(?: only)?
lgpl-3.0-or-later ~ lgpl ~ spdx license identifier lgpl 3 0 or later
lgpl-3.0-only ~ lgpl ~ spdx license identifier lgpl 3 0(?: only)?
lgpl-2.1-or-later ~ lgpl ~ spdx license identifier lgpl 2 1 or later
lgpl-2.1-only ~ lgpl ~ spdx license identifier lgpl 2 1(?: only)?
lgpl-2.0-or-later ~ lgpl ~ spdx license identifier lgpl 2 0 or later
lgpl-2.0-only ~ lgpl ~ spdx license identifier lgpl 2 0(?: only)?
gpl-3.0-or-later ~ gpl ~ spdx license identifier gpl 3 0 or later
gpl-3.0-only ~ gpl ~ spdx license identifier gpl 3 0(?: only)?
gpl-2.0-with-linux-note ~ gpl ~ spdx license identifier gpl 2 0(?: only| or later)? with linux syscall note
gpl-2.0-with-classpath ~ gpl ~ spdx license identifier gpl 2 0(?: only| or later)? with classpath exception 2 0
gpl-2.0-or-later ~ gpl ~ spdx license identifier gpl 2 0 or later
gpl-2.0-only ~ gpl ~ spdx license identifier gpl 2 0(?: only)?
gpl-1.0-or-later ~ gpl ~ spdx license identifier gpl 1 0 or later
apache-2.0-with-llvm ~ llvm ~ spdx license identifier apache 2 0 with llvm exception
apache-2.0 ~ apache ~ spdx license identifier apache 2 0
apache-1.1 ~ apache ~ spdx license identifier apache 1 1
mit-0 ~ mit ~ spdx license identifier mit 0
mit ~ mit ~ spdx license identifier mit
bsd-4-clause ~ bsd ~ spdx license identifier bsd 4 clause
bsd-3-clause-clear ~ bsd ~ spdx license identifier bsd 3 clause clear
bsd-3-clause ~ bsd ~ spdx license identifier bsd 3 clause
bsd-2-clause ~ bsd ~ spdx license identifier bsd 2 clause
bsd-1-clause ~ bsd ~ spdx license identifier bsd 1 clause
0bsd ~ 0bsd ~ spdx license identifier 0bsd
isc ~ isc ~ spdx license identifier isc
mpl-2.0 ~ mpl ~ spdx license identifier mpl 2 0
mpl-1.1 ~ mpl ~ spdx license identifier mpl 1 1
epl-2.0 ~ epl ~ spdx license identifier epl 2 0
epl-1.0 ~ epl ~ spdx license identifier epl 1 0
cddl-1.1 ~ cddl ~ spdx license identifier cddl 1 1
cddl-1.0 ~ cddl ~ spdx license identifier cddl 1 0
cc0-1.0 ~ cc0 ~ spdx license identifier cc0 1 0
cc-by-nc-sa-4.0 ~ cc ~ spdx license identifier cc by nc sa 4 0
cc-by-nc-nd-4.0 ~ cc ~ spdx license identifier cc by nc nd 4 0
cc-by-nc-4.0 ~ cc ~ spdx license identifier cc by nc 4 0
cc-by-sa-4.0 ~ cc ~ spdx license identifier cc by sa 4 0
cc-by-sa-3.0 ~ cc ~ spdx license identifier cc by sa 3 0
cc-by-nd-4.0 ~ cc ~ spdx license identifier cc by nd 4 0
cc-by-4.0 ~ cc ~ spdx license identifier cc by 4 0
cc-by-3.0 ~ cc ~ spdx license identifier cc by 3 0
unlicense ~ unlicense ~ spdx license identifier unlicense
wtfpl ~ wtfpl ~ spdx license identifier wtfpl
zlib ~ zlib ~ spdx license identifier zlib
bsl-1.0 ~ bsl ~ spdx license identifier bsl 1 0
artistic-2.0 ~ artistic ~ spdx license identifier artistic 2 0
eupl-1.2 ~ eupl ~ spdx license identifier eupl 1 2
ofl-1.1 ~ ofl ~ spdx license identifier ofl 1 1
upl-1.0 ~ upl ~ spdx license identifier upl 1 0
sspl-1.0 ~ sspl ~ spdx license identifier sspl 1 0
busl-1.1 ~ busl ~ spdx license identifier busl 1 1
elastic-2.0 ~ elastic ~ spdx license identifier elastic 2 0
postgresql ~ postgresql ~ spdx license identifier postgresql
ncsa ~ ncsa ~ spdx license identifier ncsa
gfdl-1.3 ~ gfdl ~ spdx license identifier gfdl 1 3(?: only| or later)?
spdx-other ~ spdx ~ spdx license identifier \S+(?: \d+)*
"""

#: Addresses of licence texts.
ADDRESSES = r"""
apache-2.0 ~ apache ~ (?:www )?apache org licenses license 2 0(?: txt| html)?
apache-1.1 ~ apache ~ (?:www )?apache org licenses license 1 1
gpl-2.0 ~ gnu ~ (?:www )?gnu org (?:licenses|copyleft|licenses old licenses) gpl 2 0(?: txt| html)?
gpl-3.0 ~ gnu ~ (?:www )?gnu org licenses gpl 3 0(?: txt| html)?
lgpl-2.1 ~ gnu ~ (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: txt| html)?
lgpl-3.0 ~ gnu ~ (?:www )?gnu org licenses lgpl 3 0(?: txt| html)?
agpl-3.0 ~ gnu ~ (?:www )?gnu org licenses agpl 3 0(?: txt| html)?
gfdl-1.3 ~ gnu ~ (?:www )?gnu org licenses fdl 1 3(?: txt| html)?
gnu-licenses ~ gnu ~ (?:www )?gnu org licenses
mit ~ opensource ~ opensource org licenses? mit(?: license)?(?: php| html)?
bsd-3-clause ~ opensource ~ opensource org licenses? bsd 3 clause
bsd-2-clause ~ opensource ~ opensource org licenses? bsd 2 clause
bsd ~ opensource ~ opensource org licenses? bsd license(?: php)?
apache-2.0 ~ opensource ~ opensource org licenses? apache 2 0
isc ~ opensource ~ opensource org licenses? isc(?: license)?
mpl-2.0 ~ mozilla ~ (?:www )?mozilla org (?:en us )?mpl 2 0
mpl-1.1 ~ mozilla ~ (?:www )?mozilla org mpl mpl 1 1
epl-2.0 ~ eclipse ~ (?:www )?eclipse org legal epl (?:v20|2 0)
epl-1.0 ~ eclipse ~ (?:www )?eclipse org legal epl v10
cc0-1.0 ~ creativecommons ~ creativecommons org publicdomain zero 1 0
public-domain-mark ~ creativecommons ~ creativecommons org publicdomain mark 1 0
cc-by-nc-sa-4.0 ~ creativecommons ~ creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 ~ creativecommons ~ creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0 ~ creativecommons ~ creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0 ~ creativecommons ~ creativecommons org licenses by nc nd 3 0
cc-by-nc-4.0 ~ creativecommons ~ creativecommons org licenses by nc 4 0
cc-by-nc-3.0 ~ creativecommons ~ creativecommons org licenses by nc 3 0
cc-by-sa-4.0 ~ creativecommons ~ creativecommons org licenses by sa 4 0
cc-by-sa-3.0 ~ creativecommons ~ creativecommons org licenses by sa 3 0
cc-by-nd-4.0 ~ creativecommons ~ creativecommons org licenses by nd 4 0
cc-by-nd-3.0 ~ creativecommons ~ creativecommons org licenses by nd 3 0
cc-by-4.0 ~ creativecommons ~ creativecommons org licenses by 4 0
cc-by-3.0 ~ creativecommons ~ creativecommons org licenses by 3 0
cc-by-2.0 ~ creativecommons ~ creativecommons org licenses by 2 [05]
unlicense ~ unlicense ~ (?:www )?unlicense org
wtfpl ~ wtfpl ~ (?:www )?wtfpl net
ofl-1.1 ~ sil ~ scripts sil org ofl
bsl-1.0 ~ boost ~ (?:www )?boost org license 1 0 txt
odbl-1.0 ~ opendatacommons ~ opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0 ~ opendatacommons ~ opendatacommons org licenses by(?: 1 0)?
pddl-1.0 ~ opendatacommons ~ opendatacommons org licenses pddl(?: 1 0)?
elastic-2.0 ~ elastic ~ (?:www )?elastic co licensing elastic license
"""

#: Names of licences with a version or a variant.
VERSIONS = r"""
agpl-3.0-or-later ~ affero ~ (?:gnu )?affero general public licen[cs]e (?:version |v ?)?3(?: 0)? or (?:any )?(?:later|newer)(?: version)?
agpl-3.0 ~ affero ~ (?:gnu )?affero general public licen[cs]e (?:version |v ?)?3(?: 0)?
agpl-3.0 ~ agplv3|agpl ~ agplv3|agpl (?:version |v ?)?3(?: 0)?
lgpl-3.0 ~ lesser ~ (?:gnu )?lesser general public licen[cs]e (?:version |v ?)?3(?: 0)?
lgpl-2.1 ~ lesser ~ (?:gnu )?lesser general public licen[cs]e (?:version |v ?)?2 1
lgpl-2.0 ~ library ~ gnu library general public licen[cs]e(?: (?:version |v ?)?2(?: 0)?)?
lgpl-3.0 ~ lgplv3|lgpl ~ lgplv3|lgpl (?:version |v ?)?3(?: 0)?
lgpl-2.1 ~ lgplv2|lgpl ~ lgplv2 1|lgpl (?:version |v ?)?2 1
gpl-3.0-or-later ~ general ~ (?:gnu )?general public licen[cs]e (?:version |v ?)?3(?: 0)? or (?:at your option )?(?:any )?(?:later|newer)(?: version)?
gpl-2.0-or-later ~ general ~ (?:gnu )?general public licen[cs]e (?:version |v ?)?2(?: 0)? or (?:at your option )?(?:any )?(?:later|newer)(?: version)?
gpl-3.0 ~ general ~ (?:gnu )?general public licen[cs]e (?:version |v ?)?3(?: 0)?
gpl-2.0 ~ general ~ (?:gnu )?general public licen[cs]e (?:version |v ?)?2(?: 0)?
gpl-1.0 ~ general ~ (?:gnu )?general public licen[cs]e (?:version |v ?)?1(?: 0)?
gpl-3.0 ~ gplv3 ~ gplv3(?: 0)?
gpl-2.0 ~ gplv2 ~ gplv2(?: 0)?
gpl-3.0-or-later ~ gpl ~ gpl 3 0 or later
gpl-2.0-or-later ~ gpl ~ gpl 2 0 or later
gpl-3.0 ~ gpl ~ gpl (?:version |v ?)?3(?: 0)?(?: only)?
gpl-2.0 ~ gpl ~ gpl (?:version |v ?)?2(?: 0)?(?: only)?
gfdl-1.3 ~ documentation ~ gnu free documentation licen[cs]e (?:version |v ?)?1 3
gfdl-1.2 ~ documentation ~ gnu free documentation licen[cs]e (?:version |v ?)?1 2
apache-2.0-with-llvm ~ llvm ~ apache licen[cs]e (?:version |v ?)?2 0 with llvm exceptions?
apache-2.0 ~ apache ~ apache (?:software )?(?:public )?licen[cs]e (?:version |v ?)?2(?: 0)?
apache-1.1 ~ apache ~ apache (?:software )?licen[cs]e (?:version |v ?)?1 1
apache-1.0 ~ apache ~ apache (?:software )?licen[cs]e (?:version |v ?)?1 0
apache-2.0 ~ apache ~ apache (?:v ?)?2 0(?: licen[cs]e)?
apache-2.0 ~ asl ~ asl 2 0
cc-by-nc-sa-4.0 ~ cc ~ cc by nc sa (?:version |v ?)?4 0(?: international)?
cc-by-nc-sa-3.0 ~ cc ~ cc by nc sa (?:version |v ?)?3 0(?: unported)?
cc-by-nc-sa ~ cc ~ cc by nc sa
cc-by-nc-nd-4.0 ~ cc ~ cc by nc nd (?:version |v ?)?4 0(?: international)?
cc-by-nc-nd-3.0 ~ cc ~ cc by nc nd (?:version |v ?)?3 0(?: unported)?
cc-by-nc-nd ~ cc ~ cc by nc nd
cc-by-nc-4.0 ~ cc ~ cc by nc (?:version |v ?)?4 0(?: international)?
cc-by-nc-3.0 ~ cc ~ cc by nc (?:version |v ?)?3 0(?: unported)?
cc-by-nc ~ cc ~ cc by nc
cc-by-sa-4.0 ~ cc ~ cc by sa (?:version |v ?)?4 0(?: international)?
cc-by-sa-3.0 ~ cc ~ cc by sa (?:version |v ?)?3 0(?: unported)?
cc-by-sa-2.5 ~ cc ~ cc by sa (?:version |v ?)?2 5
cc-by-sa ~ cc ~ cc by sa
cc-by-nd-4.0 ~ cc ~ cc by nd (?:version |v ?)?4 0(?: international)?
cc-by-nd ~ cc ~ cc by nd
cc-by-4.0 ~ cc ~ cc by (?:version |v ?)?4 0(?: international)?
cc-by-3.0 ~ cc ~ cc by (?:version |v ?)?3 0(?: unported)?
cc-by-2.5 ~ cc ~ cc by (?:version |v ?)?2 5
cc-by-2.0 ~ cc ~ cc by (?:version |v ?)?2 0
cc-by-nc-sa-4.0 ~ creative ~ creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-sa-3.0 ~ creative ~ creative commons attribution non ?commercial share ?alike 3 0
cc-by-nc-nd-4.0 ~ creative ~ creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? 4 0(?: international)?
cc-by-nc-4.0 ~ creative ~ creative commons attribution non ?commercial 4 0(?: international)?
cc-by-sa-4.0 ~ creative ~ creative commons attribution share ?alike 4 0(?: international)?
cc-by-sa-3.0 ~ creative ~ creative commons attribution share ?alike 3 0
cc-by-nd-4.0 ~ creative ~ creative commons attribution no ?deriv(?:ative)?s?(?: works)? 4 0(?: international)?
cc-by-4.0 ~ creative ~ creative commons attribution 4 0(?: international)?
cc-by-3.0 ~ creative ~ creative commons attribution 3 0
cc0-1.0 ~ cc0 ~ cc0(?: 1 0)?(?: universal)?
bsd-4-clause ~ bsd ~ (?:4|four) clause bsd|bsd (?:4|four) clause
bsd-3-clause ~ bsd ~ (?:3|three) clause bsd|bsd (?:3|three) clause|(?:new|modified|revised) bsd
bsd-2-clause ~ bsd|freebsd ~ (?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd licen[cs]e
0bsd ~ bsd|0bsd ~ zero clause bsd|0bsd
mpl-2.0 ~ mozilla ~ mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?
mpl-1.1 ~ mozilla ~ mozilla public licen[cs]e (?:version |v ?)?1 1
mpl-2.0 ~ mpl ~ mpl (?:version |v ?)?2 0
epl-2.0 ~ eclipse ~ eclipse public licen[cs]e (?:version |v ?)?2(?: 0)?
epl-1.0 ~ eclipse ~ eclipse public licen[cs]e (?:version |v ?)?1(?: 0)?
cpl-1.0 ~ common ~ common public licen[cs]e (?:version |v ?)?1 0
cddl-1.1 ~ cddl ~ cddl (?:version |v ?)?1 1
cddl-1.0 ~ cddl ~ cddl(?: (?:version |v ?)?1 0)?
artistic-2.0 ~ artistic ~ artistic licen[cs]e (?:version |v ?)?2(?: 0)?
artistic-1.0 ~ artistic ~ artistic licen[cs]e (?:version |v ?)?1(?: 0)?
eupl-1.2 ~ european ~ european union public licen[cs]e (?:version |v ?)?1 2
ofl-1.1 ~ font ~ sil open font licen[cs]e(?: (?:version |v ?)?1 1)?
bsl-1.0 ~ boost ~ boost software licen[cs]e(?: (?:version |v ?)?1 0)?
osl-3.0 ~ open ~ open software licen[cs]e (?:version |v ?)?3 0
afl-3.0 ~ academic ~ academic free licen[cs]e (?:version |v ?)?3 0
odbl-1.0 ~ database ~ open (?:data commons open )?database licen[cs]e(?: (?:version |v ?)?1 0)?
sspl-1.0 ~ server ~ server side public licen[cs]e(?: (?:version |v ?)?1)?
busl-1.1 ~ business ~ business source licen[cs]e(?: (?:version |v ?)?1 1)?
polyform-noncommercial-1.0.0 ~ polyform ~ polyform noncommercial licen[cs]e(?: 1 0 0)?
openrail ~ openrail ~ (?:creativeml |bigscience )?openrail(?: m)?(?: licen[cs]e)?
llama-2 ~ llama ~ llama 2 community licen[cs]e
llama-3 ~ llama ~ llama 3(?: \d)? community licen[cs]e
gpl-with-classpath ~ classpath ~ (?:gnu )?classpath (?:linking )?exception
"""

#: Names without a version; the base phrases are among them.
NAMES = r"""
agpl ~ affero|agpl ~ (?:gnu )?affero general public licen[cs]e|agpl
lgpl ~ lesser|lgpl ~ (?:gnu )?lesser general public licen[cs]e|lgpl
gfdl ~ documentation|gfdl ~ gnu free documentation licen[cs]e|gfdl
gpl ~ gnu ~ gnu general public license
gpl ~ gnu ~ gnu general public licence
gpl ~ gnu ~ gnu gpl
gpl ~ gpl ~ (?:licensed under|under|distributed under|released under) the gpl
apache ~ apache ~ apache license
apache ~ apache ~ apache (?:software |public )?licence
apache ~ apache ~ apache licensed
cc-by ~ cc ~ cc by
mit ~ mit ~ mit license
mit ~ mit ~ mit licence|mit licensed|mit style licen[cs]e|expat licen[cs]e mit
mit ~ expat ~ expat licen[cs]e
bsd ~ bsd ~ bsd (?:style )?licen[cs]ed?
isc ~ isc ~ isc licen[cs]e
mpl ~ mozilla ~ mozilla public licen[cs]e
epl ~ eclipse ~ eclipse public licen[cs]e
cddl ~ development ~ common development and distribution licen[cs]e
artistic ~ artistic ~ artistic licen[cs]e
zlib ~ zlib ~ zlib(?: libpng)? licen[cs]e
python ~ python ~ python (?:software foundation )?licen[cs]e
php ~ php ~ php licen[cs]e
ruby ~ ruby ~ ruby licen[cs]e
perl ~ perl ~ (?:under )?the same terms as perl(?: itself)?
postgresql ~ postgresql ~ postgresql licen[cs]e
openssl ~ openssl ~ openssl licen[cs]e
eupl ~ european ~ european union public licen[cs]e
wtfpl ~ wtfpl ~ wtfpl
unlicense ~ unlicense ~ the unlicense
beerware ~ beerware|beer ~ (?:the )?beer ?ware licen[cs]e
vim ~ vim ~ vim licen[cs]e
ncsa ~ illinois ~ university of illinois (?:ncsa )?open source licen[cs]e
ms-pl ~ microsoft ~ microsoft public licen[cs]e
ms-rl ~ microsoft ~ microsoft reciprocal licen[cs]e
elastic ~ elastic ~ elastic licen[cs]e
cc-by-nc-sa ~ creative ~ creative commons attribution non ?commercial share ?alike
cc-by-nc ~ creative ~ creative commons attribution non ?commercial
cc-by-sa ~ creative ~ creative commons attribution share ?alike
cc-by-nd ~ creative ~ creative commons attribution no ?deriv(?:ative)?s?
cc-by ~ creative ~ creative commons attribution
creative-commons ~ creative ~ creative commons (?:public )?licen[cs]e
creative-commons ~ creative ~ licen[cs]e creative commons|creative commons lizenz|licencia creative commons
"""

#: Weak signs: a reservation of rights, a domain, a name alone.
MENTIONS = r"""
public-domain ~ domain ~ (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain ~ gemeinfrei ~ (?:ist|sind) gemeinfrei
proprietary ~ proprietary ~ proprietary and confidential
proprietary ~ unauthorized ~ unauthorized (?:copying|reproduction|distribution) (?:of this \S+ )?(?:\S+ ){0,6}is (?:strictly )?prohibited
all-rights-reserved ~ reserved ~ all rights reserved
all-rights-reserved ~ vorbehalten ~ alle rechte vorbehalten
all-rights-reserved ~ réservés ~ tous droits réservés
all-rights-reserved ~ reservados ~ todos los derechos reservados
no-commercial-use ~ commercial ~ (?:for )?non commercial use only
research-only ~ research ~ for (?:academic )?research (?:use|purposes) only
gpl-compatible ~ compatible ~ gpl compatible
see-license-file ~ see ~ see (?:the )?(?:accompanying )?(?:file )?(?:license|licence|copying|copyright) (?:file )?for (?:more )?(?:details|terms|information)
copyright-notice ~ copyright ~ copyright (?:c |© )?(?:19|20)\d\d(?: (?:19|20)\d\d)?
"""

#: (weight of a detection, rules), strongest first.
TIERS = ((1.0, TEXTS), (0.98, TAGS), (0.95, ADDRESSES), (0.9, VERSIONS), (0.75, NAMES), (0.3, MENTIONS))
