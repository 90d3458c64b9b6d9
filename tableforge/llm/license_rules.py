"""The signature rules of the licence scan, one a line: label; level; words; pattern.

A pattern reads normalised text: lower-case words with one blank between them ("GPL-3.0+" is "gpl 3 0"). ``words`` are
words that every match holds ("licen~" is the beginning of one); a rule runs only where all of them occur. Levels: 3 for tags, addresses and the licences' own
sentences, 2 for statements that something is under a licence, 1 for bare names. Patterns use literals, groups, ``?``,
classes and look-ahead only.
"""

RULES_TEXT = """
mit; 3; spdx license identifier mit; spdx license identifier mit
mit; 3; opensource licenses mit; opensource org licenses mit(?: license)?
mit; 3; permission granted charge obtaining deal restriction; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
mit; 3; notice permission substantial portions; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit; 2; under mit; (?:licensed|released|distributed|available|published|provided|covered|offered|shared) under (?:the )?(?:terms of (?:the )?)?mit(?: style| x11| expat)?(?: licen[cs]e)?
mit; 2; under mit; under (?:the )?(?:terms of (?:the )?)?mit(?: x11| expat)? licen[cs]e
mit; 2; subject mit; subject to (?:the )?(?:terms of (?:the )?)?mit(?: licen[cs]e)?
mit; 2; licen~ mit; licen[cs]e (?:is |type )?mit(?! dem| der| den| einer| einem| einen| und| freundlicher)
mit; 2; mit licensed; mit licensed
mit; 2; mit apache; mit or apache(?: 2| 2 0| license)?
mit; 2; apache mit; apache (?:2 0 |2 )?or mit(?: licen[cs]e)?
mit; 2; dual~ mit; dual(?:ly)? (?:licensed )?(?:under )?(?:the )?mit
mit; 1; mit license; (?:the )?mit(?: x11)?(?: expat)? license
mit; 1; mit licence; (?:the )?mit licence
mit; 1; expat license; expat license
mit; 1; x11 license; x11 license
mit-0; 3; spdx license mit 0; spdx license identifier mit 0
mit-0; 2; mit 0 license; mit 0 license
mit-0; 2; mit attribution; mit no attribution(?: license)?
apache-2; 3; spdx license apache 2; spdx license identifier apache 2 0
apache-2; 3; apache licenses license 2; apache org licenses license 2 0
apache-2; 3; apache license except compliance; licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2; 2; under apache 2; (?:licensed|released|distributed|available|published|provided|covered) under (?:the )?(?:terms of (?:the )?)?apache(?: software)?(?: license)?(?: version| v)? 2(?: 0)?(?: license)?
apache-2; 2; under apachev2; under (?:the )?apachev2
apache-2; 2; license apache 2; license apache (?:license )?(?:version )?2(?: 0)?
apache-2; 1; apache license 2; apache(?: software)? license(?: version| v)? 2(?: 0)?
apache-2; 1; apache license v2; apache(?: software)? license v2(?: 0)?
apache-2; 1; apache 2; apache(?: version| v)? 2 0(?: license)?
apache-2; 1; apache 2 license; apache 2 license
apache-2; 1; asl 2; asl 2 0
apache-1.1; 3; spdx license apache 1; spdx license identifier apache 1 1
apache-1.1; 1; apache license 1; apache(?: software)? license(?: version| v)? 1 1
apache-1; 1; apache license 1 0; apache(?: software)? license(?: version| v)? 1 0
apache; 2; under apache license; under (?:the )?(?:terms of (?:the )?)?apache(?: software)? license
gpl-1; 3; spdx license gpl 1; spdx license identifier gpl 1 0(?: only| or later)?
gpl-2; 3; spdx license gpl 2; spdx license identifier gpl 2 0(?: only| or later)?
gpl-3; 3; spdx license gpl 3; spdx license identifier gpl 3 0(?: only| or later)?
gpl-2; 3; gnu licenses gpl 2; gnu org licenses (?:old licenses )?gpl 2 0
gpl-3; 3; gnu licenses gpl 3; gnu org licenses gpl 3 0
gpl; 3; gnu licenses gpl; gnu org licenses gpl
gpl-2; 3; redistribute modify gnu version 2; redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2(?: of the license)?
gpl-3; 3; redistribute modify gnu version 3; redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3(?: of the license)?
gpl-2; 2; under gnu license 2; under (?:the )?(?:terms of (?:the )?)?gnu general public license(?: gpl)?(?: version| v)? 2(?: 0)?
gpl-3; 2; under gnu license 3; under (?:the )?(?:terms of (?:the )?)?gnu general public license(?: gpl)?(?: version| v)? 3(?: 0)?
gpl-2; 2; under gpl 2; under (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl(?: version| v)? 2(?: 0)?
gpl-3; 2; under gpl 3; under (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl(?: version| v)? 3(?: 0)?
gpl-2; 2; under gplv2; under (?:the )?(?:terms of (?:the )?)?gplv2
gpl-3; 2; under gplv3; under (?:the )?(?:terms of (?:the )?)?gplv3
gpl; 2; under gpl; under (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl
gpl; 2; under gnu general license; under (?:the )?(?:terms of (?:the )?)?gnu general public license
gpl-2; 1; gnu general license 2; gnu general public license(?: gpl)?(?: version| v)? 2(?: 0)?
gpl-3; 1; gnu general license 3; gnu general public license(?: gpl)?(?: version| v)? 3(?: 0)?
gpl-2; 1; gnu general license v2; gnu general public license v2(?: 0)?
gpl-3; 1; gnu general license v3; gnu general public license v3(?: 0)?
gpl; 1; gnu general licen~; gnu general public licen[cs]e
gpl-2; 1; gpl 2; (?:gnu )?gpl(?: version| v)? 2(?: 0)?(?: only| or later)?
gpl-3; 1; gpl 3; (?:gnu )?gpl(?: version| v)? 3(?: 0)?(?: only| or later)?
gpl-2; 1; gpl v2; (?:gnu )?gpl v2(?: 0)?
gpl-3; 1; gpl v3; (?:gnu )?gpl v3(?: 0)?
gpl-2; 1; gplv2; gplv2
gpl-3; 1; gplv3; gplv3
gpl; 1; gnu gpl; gnu gpl
gpl; 1; gpl licen~; gpl licen[cs]e
gpl; 1; gpl licensed; gpl licensed
lgpl-2; 3; spdx license lgpl 2 0; spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1; 3; spdx license lgpl 2 1; spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3; 3; spdx license lgpl 3; spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2.1; 3; gnu licenses lgpl 2; gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3; 3; gnu licenses lgpl 3; gnu org licenses lgpl 3 0
lgpl; 3; redistribute modify gnu lesser; redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl-2.1; 2; under lgpl 2; under (?:the )?(?:terms of (?:the )?)?(?:gnu )?lgpl(?: version| v)? 2 1
lgpl-3; 2; under lgpl 3; under (?:the )?(?:terms of (?:the )?)?(?:gnu )?lgpl(?: version| v)? 3(?: 0)?
lgpl; 2; under lgpl; under (?:the )?(?:terms of (?:the )?)?(?:gnu )?lgpl
lgpl; 2; under gnu lesser; under (?:the )?(?:terms of (?:the )?)?gnu lesser general public license
lgpl-2; 1; gnu library license; gnu library general public license(?: version| v)?(?: 2)?(?: 0)?
lgpl-2.1; 1; gnu lesser license 2; gnu lesser general public license(?: version| v)? 2 1
lgpl-3; 1; gnu lesser license 3; gnu lesser general public license(?: version| v)? 3(?: 0)?
lgpl; 1; gnu lesser licen~; gnu lesser general public licen[cs]e
lgpl-2.1; 1; lgpl 2; (?:gnu )?lgpl(?: version| v)? 2 1(?: only| or later)?
lgpl-2.1; 1; lgplv2; lgplv2 1
lgpl-3; 1; lgpl 3; (?:gnu )?lgpl(?: version| v)? 3(?: 0)?(?: only| or later)?
lgpl-3; 1; lgplv3; lgplv3
lgpl; 1; lgpl; lgpl
agpl-3; 3; spdx license agpl 3; spdx license identifier agpl 3 0(?: only| or later)?
agpl-3; 3; gnu licenses agpl; gnu org licenses agpl(?: 3 0)?
agpl-3; 2; under agpl; under (?:the )?(?:terms of (?:the )?)?(?:gnu )?agpl(?: version| v)?(?: 3)?(?: 0)?
agpl-3; 2; under affero license; under (?:the )?(?:terms of (?:the )?)?(?:gnu )?affero general public license(?: version| v)?(?: 3)?(?: 0)?
agpl-3; 1; affero licen~; (?:gnu )?affero general public licen[cs]e(?: version| v)?(?: 3)?(?: 0)?
agpl-3; 1; agpl; (?:gnu )?agpl(?: version| v| v3)?(?: 3)?(?: 0)?(?: only| or later)?
agpl-3; 1; agplv3; agplv3
gfdl; 3; spdx license gfdl; spdx license identifier gfdl 1 [1-3](?: only| or later)?
gfdl; 1; gnu free documentation license; gnu free documentation license(?: version)?(?: 1 [1-3])?
gfdl; 1; gfdl; gfdl
bsd-2; 3; spdx license bsd 2; spdx license identifier bsd 2 clause
bsd-3; 3; spdx license bsd 3; spdx license identifier bsd 3 clause
bsd-4; 3; spdx license bsd 4; spdx license identifier bsd 4 clause
bsd-2; 3; opensource licenses bsd 2; opensource org licenses bsd 2 clause
bsd-3; 3; opensource licenses bsd 3; opensource org licenses bsd 3 clause
bsd; 3; redistribution source binary modification permitted conditions; redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3; 3; neither endorse promote derived permission; neither the name of (?:the )?(?:copyright holder|university|author|company)(?: nor the names of its contributors)? may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4; 3; advertising acknowledgement display; all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd; 2; under bsd; (?:licensed|released|distributed|available|published|provided) under (?:the |a )?(?:terms of (?:the |a )?)?bsd(?: style)?(?: licen[cs]e)?
bsd-2; 1; bsd 2 clause; bsd 2 clause(?: license)?
bsd-2; 1; 2 clause bsd; 2 clause bsd(?: license)?
bsd-2; 1; two clause bsd; two clause bsd(?: license)?
bsd-2; 1; simplified bsd; simplified bsd(?: license)?
bsd-2; 1; freebsd license; freebsd license
bsd-3; 1; bsd 3 clause; bsd 3 clause(?: license)?
bsd-3; 1; 3 clause bsd; 3 clause bsd(?: license)?
bsd-3; 1; three clause bsd; three clause bsd(?: license)?
bsd-3; 1; new bsd; new bsd(?: license)?
bsd-3; 1; modified bsd; modified bsd(?: license)?
bsd-3; 1; revised bsd; revised bsd(?: license)?
bsd-4; 1; bsd 4 clause; bsd 4 clause(?: license)?
bsd-4; 1; 4 clause bsd; 4 clause bsd(?: license)?
bsd-4; 1; original bsd license; original bsd license
bsd; 1; bsd licen~; bsd(?: style)? licen[cs]e
bsd; 1; bsd licensed; bsd licensed
0bsd; 1; 0bsd; 0bsd(?: license)?
0bsd; 1; zero clause bsd; zero clause bsd(?: license)?
isc; 3; spdx license isc; spdx license identifier isc
isc; 3; permission copy modify distribute fee hereby; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc; 2; under isc; (?:licensed|released|distributed|available) under (?:the )?isc(?: license)?
isc; 1; isc licen~; isc licen[cs]e
mpl-1.1; 3; spdx license mpl 1; spdx license identifier mpl 1 1
mpl-2; 3; spdx license mpl 2; spdx license identifier mpl 2 0
mpl-2; 3; mozilla mpl 2; mozilla org mpl 2 0
mpl-2; 3; source code subject mozilla; this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2; 2; under mozilla license 2; under (?:the )?(?:terms of (?:the )?)?mozilla public license(?: version| v)? 2(?: 0)?
mpl-2; 2; under mpl 2; under (?:the )?(?:terms of (?:the )?)?mpl(?: version| v)? 2(?: 0)?
mpl-1.1; 1; mozilla license 1; mozilla public license(?: version| v)? 1 1
mpl-2; 1; mozilla license 2; mozilla public license(?: version| v)? 2(?: 0)?
mpl; 1; mozilla licen~; mozilla public licen[cs]e
mpl-1.1; 1; mpl 1; mpl(?: version| v)? 1 1
mpl-2; 1; mpl 2; mpl(?: version| v)? 2(?: 0)?
mpl-2; 1; mplv2; mplv2
epl-1; 3; spdx license epl 1; spdx license identifier epl 1 0
epl-2; 3; spdx license epl 2; spdx license identifier epl 2 0
epl-1; 1; eclipse license 1; eclipse public license(?: version| v)? 1(?: 0)?
epl-2; 1; eclipse license 2; eclipse public license(?: version| v)? 2(?: 0)?
epl-1; 1; eclipse license v1; eclipse public license v1 0
epl-2; 1; eclipse license v2; eclipse public license v2 0
epl; 1; eclipse license; eclipse public license
epl-2; 1; epl 2; epl 2 0
edl-1; 1; eclipse distribution license; eclipse distribution license(?: version| v)?(?: 1 0)?
cddl-1; 3; spdx license cddl; spdx license identifier cddl 1 [01]
cddl-1; 1; cddl; cddl(?: version| v)?(?: 1)?(?: 0| 1)?
cddl-1; 1; common development distribution license; common development and distribution license(?: cddl)?(?: version| v)?(?: 1 [01])?
cpl-1; 1; common license 1; common public license(?: version| v)? 1 0
ibmpl-1; 1; ibm license; ibm public license(?: version| v)?(?: 1 0)?
eupl-1.1; 1; eupl 1 1; eupl(?: version| v)? 1 1
eupl-1.2; 3; spdx license eupl 2; spdx license identifier eupl 1 2
eupl-1.2; 1; eupl; eupl(?: version| v| v1)?(?: 1)?(?: 2)?
eupl-1.2; 1; european union licen~; european union public licen[cs]e(?: version| v)?(?: 1 2)?
artistic-1; 1; artistic license 1; artistic license(?: version| v)? 1 0
artistic-2; 3; spdx license artistic 2; spdx license identifier artistic 2 0
artistic-2; 1; artistic license 2; artistic license(?: version| v)? 2(?: 0)?
artistic; 1; artistic license; artistic license
unlicense; 3; spdx unlicense; spdx license identifier unlicense
unlicense; 3; free unencumbered released domain; this is free and unencumbered software released into the public domain
unlicense; 1; unlicense; (?:the )?unlicense
zlib; 3; spdx license zlib; spdx license identifier zlib
zlib; 3; altered source plainly marked misrepresented; altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib; 1; zlib licen~; zlib(?: libpng)? licen[cs]e
libpng; 1; libpng license; libpng license(?: version 2)?
bsl-1; 3; spdx license bsl 1; spdx license identifier bsl 1 0
bsl-1; 3; boost org license 1; boost org license 1 0
bsl-1; 1; boost license; boost software license(?: version| v)?(?: 1)?(?: 0)?
busl-1.1; 3; spdx license busl; spdx license identifier busl 1 1
busl-1.1; 1; business source license; business source license(?: version| v)?(?: 1 1)?
ofl-1.1; 3; spdx license ofl; spdx license identifier ofl 1 1
ofl-1.1; 1; sil font license; sil open font license(?: version| v)?(?: 1 1)?
ofl-1.1; 1; open font license; open font license(?: version| v)?(?: 1 1)?
ofl-1.1; 1; ofl 1; ofl 1 1
odbl; 3; spdx license odbl; spdx license identifier odbl 1 0
odbl; 3; opendatacommons odbl; opendatacommons org licenses odbl
odbl; 1; open database license; open database license
odbl; 1; odbl; odbl(?: version| v)?(?: 1)?(?: 0)?
odc-by; 1; data commons attribution; open data commons attribution license
odc-by; 1; odc by; odc by(?: 1 0)?
pddl; 1; public dedication license; public domain dedication and license
postgresql; 3; spdx license postgresql; spdx license identifier postgresql
postgresql; 1; postgresql licen~; postgresql licen[cs]e
python-2; 3; spdx license python 2; spdx license identifier python 2 0
python-2; 1; python foundation license; python software foundation license(?: version| v)?(?: 2)?(?: 0)?
python-2; 1; psf license; psf license(?: version| v)?(?: 2)?
php-3; 1; php license; php license(?: version| v)?(?: 3 0)?(?: 1)?
ruby; 1; ruby licen~; ruby licen[cs]e
perl; 1; same terms perl itself; under the same terms as perl itself
wtfpl; 3; spdx license wtfpl; spdx license identifier wtfpl
wtfpl; 1; wtfpl; wtfpl(?: license)?
wtfpl; 1; do want license; do what the fuck you want to public license
beerware; 1; beer ware license; beer ware license
beerware; 1; beerware; beerware
openssl; 1; openssl license; openssl license
ssleay; 1; ssleay license; (?:original )?ssleay license
ncsa; 1; illinois ncsa license; university of illinois ncsa open source license
upl-1; 1; universal permissive license; universal permissive license(?: version| v)?(?: 1 0)?
ms-pl; 1; microsoft public license; microsoft public license
ms-rl; 1; microsoft reciprocal license; microsoft reciprocal license
afl-3; 1; academic free license; academic free license(?: version| v)?(?: 3 0)?
osl-3; 1; open license 3; open software license(?: version| v)? 3 0
ecl-2; 1; educational community license; educational community license(?: version| v)?(?: 2 0)?
apsl-2; 1; apple source license; apple public source license(?: version| v)?(?: 2 0)?
qpl-1; 1; q public license; q public license
cecill-2.1; 1; cecill; cecill(?: b| c)?(?: version)?(?: 2 1)?
mulan-2; 1; mulan; mulan (?:psl|permissive software license)(?: version| v)?(?: 2)?
sspl-1; 1; server side public license; server side public license(?: version| v)?(?: 1)?
sspl-1; 1; sspl; sspl(?: 1 0| v1)?
elastic-2; 1; elastic license; elastic license(?: version| v)?(?: 2 0| 2)?
commons-clause; 1; commons clause; commons clause(?: license condition)?
polyform; 1; polyform license; polyform (?:noncommercial|shield|perimeter|strict|small business) license(?: 1 0 0)?
rail; 1; openrail; (?:creativeml |bigscience )?openrail(?: m)?
llama; 1; llama community license; llama (?:2 |3 |3 1 )?community license(?: agreement)?
cc0; 3; spdx license cc0; spdx license identifier cc0 1 0
cc0; 3; creativecommons publicdomain zero; creativecommons org publicdomain zero(?: 1 0)?
cc0; 2; cc0; (?:released|licensed|available|dedicated|published) (?:under|using|via) (?:the )?cc0
cc0; 1; cc0; cc0(?: 1 0)?(?: universal)?
cc0; 1; cc zero; cc zero
cc-by; 3; creativecommons licenses by; creativecommons org licenses by(?: [1-4] [0-9])?(?! nc| nd| sa)
cc-by-sa; 3; creativecommons licenses by sa; creativecommons org licenses by sa(?: [1-4] [0-9])?
cc-by-nd; 3; creativecommons licenses by nd; creativecommons org licenses by nd(?: [1-4] [0-9])?
cc-by-nc; 3; creativecommons licenses by nc; creativecommons org licenses by nc(?: [1-4] [0-9])?(?! nd| sa)
cc-by-nc-sa; 3; creativecommons licenses by nc sa; creativecommons org licenses by nc sa(?: [1-4] [0-9])?
cc-by-nc-nd; 3; creativecommons licenses by nc nd; creativecommons org licenses by nc nd(?: [1-4] [0-9])?
cc-by; 3; spdx license cc by; spdx license identifier cc by [1-4] [0-9]
cc-by-sa; 3; spdx license cc by sa; spdx license identifier cc by sa [1-4] [0-9]
cc-by-nc; 3; spdx license cc by nc; spdx license identifier cc by nc [1-4] [0-9]
cc-by; 2; under cc by; under (?:a |the )?(?:terms of (?:the )?)?cc by(?: [1-4] [0-9])?(?! nc| nd| sa)
cc-by-sa; 2; under cc by sa; under (?:a |the )?(?:terms of (?:the )?)?cc by sa(?: [1-4] [0-9])?
cc-by-nc; 2; under cc by nc; under (?:a |the )?(?:terms of (?:the )?)?cc by nc(?: [1-4] [0-9])?(?! nd| sa)
cc-by; 1; cc by; cc by(?: [1-4] [0-9])?(?! nc| nd| sa)
cc-by-sa; 1; cc by sa; cc by sa(?: [1-4] [0-9])?
cc-by-nd; 1; cc by nd; cc by nd(?: [1-4] [0-9])?
cc-by-nc; 1; cc by nc; cc by nc(?: [1-4] [0-9])?(?! nd| sa)
cc-by-nc-sa; 1; cc by nc sa; cc by nc sa(?: [1-4] [0-9])?
cc-by-nc-nd; 1; cc by nc nd; cc by nc nd(?: [1-4] [0-9])?
cc-by; 1; creative commons attribution; creative commons attribution(?: [1-4] [0-9])?(?: international| unported| generic)?(?: license)?(?! non| noncommercial| no| noderivatives| noderivs| share| sharealike)
cc-by-sa; 1; creative commons attribution sharealike; creative commons attribution sharealike(?: [1-4] [0-9])?
cc-by-sa; 1; creative commons attribution share alike; creative commons attribution share alike(?: [1-4] [0-9])?
cc-by-nd; 1; creative commons attribution noderivatives; creative commons attribution noderivatives(?: [1-4] [0-9])?
cc-by-nd; 1; creative commons attribution noderivs; creative commons attribution noderivs(?: [1-4] [0-9])?
cc-by-nc; 1; creative commons attribution noncommercial; creative commons attribution noncommercial(?: [1-4] [0-9])?(?! share| sharealike| no| noderivatives| noderivs)
cc-by-nc; 1; creative commons attribution non commercial; creative commons attribution non commercial(?: [1-4] [0-9])?(?! share| sharealike| no| noderivatives)
cc-by-nc-sa; 1; creative attribution noncommercial sharealike; creative commons attribution noncommercial sharealike(?: [1-4] [0-9])?
cc-by-nc-nd; 1; creative attribution noncommercial noderivatives; creative commons attribution noncommercial noderivatives(?: [1-4] [0-9])?
cc; 1; creative commons licen~; creative commons licen[cs]e
public-domain; 2; public domain; (?:dedicated|released|placed) (?:to|in|into) the public domain
public-domain; 2; creativecommons publicdomain mark; creativecommons org publicdomain mark(?: 1 0)?
public-domain; 1; public domain; public domain
proprietary; 2; proprietary confidential; proprietary and confidential
proprietary; 2; unauthorized copying prohibited; unauthorized copying of this file via any medium is strictly prohibited
proprietary; 2; proprietary licen~; proprietary licen[cs]e
proprietary; 1; proprietary software; proprietary software
"""
