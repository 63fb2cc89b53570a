"""The ordered signature rules of operator 11: regular expressions over normalised words, first rules first.

A text is matched as its words, lower-cased and parted by single spaces ("SPDX-License-Identifier: Apache-2.0" reads
"spdx license identifier apache 2 0"), so the expressions need no punctuation. LICENSES names each license once (label,
how texts write its name, how its identifier reads, a piece of the name that every match holds); the frames TAG, GRANT
and NAME make three rules of each. NOTICES and LINKS are written out rule by rule. Order is priority: tags, notices,
links, grants, names from the particular to the general, then the plain phrases.
"""

from __future__ import annotations

from dataclasses import dataclass

GNU = r"gnu (?:gpl|general public licen[sc]e)"
VERSION = r"(?:version |ver |v )?"

# label, name, identifier ("" if none), keywords: every match of the name holds one of them. The more particular names come first.
LICENSES = [
    ("agpl-3.0-or-later", r"(?:gnu )?(?:affero general public licen[sc]e|agpl) (?:version |v)?3(?: 0)? or (?:any )?later", "agpl 3 0 or later", "affero|agpl"),
    ("agpl-3.0", r"(?:gnu )?(?:affero general public licen[sc]e|agpl) (?:version |v)?3(?: 0)?", r"agpl 3 0(?: only)?", "affero|agpl"),
    ("agpl-3.0", r"agplv3", "agplv3", "affero|agpl"),
    ("agpl-1.0", r"(?:affero general public licen[sc]e|agpl) (?:version |v)?1(?: 0)?", r"agpl 1 0(?: only| or later)?", "affero|agpl"),
    ("agpl", r"gnu affero general public licen[sc]e", "", "affero|agpl"),
    ("agpl", r"affero general public licen[sc]e", "", "affero|agpl"),
    ("lgpl-3.0-or-later", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl) (?:version |v)?3(?: 0)? or (?:any )?later", "lgpl 3 0 or later", "lesser general|library general|lgpl"),
    ("lgpl-3.0", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl) (?:version |v)?3(?: 0)?", r"lgpl 3 0(?: only)?", "lesser general|library general|lgpl"),
    ("lgpl-3.0", r"lgplv3", "lgplv3", "lesser general|library general|lgpl"),
    ("lgpl-2.1-or-later", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl) (?:version |v)?2 1 or (?:any )?later", "lgpl 2 1 or later", "lesser general|library general|lgpl"),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl) (?:version |v)?2 1", r"lgpl 2 1(?: only)?", "lesser general|library general|lgpl"),
    ("lgpl-2.0", r"(?:gnu )?(?:library general public licen[sc]e|lgpl) (?:version |v)?2(?: 0)?", r"lgpl 2 0(?: only| or later)?", "lesser general|library general|lgpl"),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", "", "lesser general|library general|lgpl"),
    ("lgpl", r"gnu lgpl", "", "lesser general|library general|lgpl"),
    ("gpl-3.0-or-later", GNU + r" (?:version |v)?3(?: 0)? or (?:any )?later", "gpl 3 0 or later", "gnu gpl|gnu general public"),
    ("gpl-3.0", GNU + r" (?:version |v)?3(?: 0)?", r"gpl 3 0(?: only)?", "gnu gpl|gnu general public"),
    ("gpl-3.0", r"(?:gpl v?3(?: 0)?|gplv3)", "gplv3", "gpl"),
    ("gpl-2.0-or-later", GNU + r" (?:version |v)?2(?: 0)? or (?:any )?later", "gpl 2 0 or later", "gnu gpl|gnu general public"),
    ("gpl-2.0-with-classpath", r"gpl (?:version |v)?2(?: 0)? with (?:the )?classpath exception", "gpl 2 0 with classpath exception 2 0", "classpath"),
    ("gpl-2.0", GNU + r" (?:version |v)?2(?: 0)?", r"gpl 2 0(?: only)?", "gnu gpl|gnu general public"),
    ("gpl-2.0", r"(?:gpl v?2(?: 0)?|gplv2)", "gplv2", "gpl"),
    ("gpl-1.0", GNU + r" (?:version |v)?1(?: 0)?", r"gpl 1 0(?: only| or later)?", "gnu gpl|gnu general public"),
    ("gpl", r"gnu general public licen[sc]e", "", "gnu gpl|gnu general public"),
    ("gpl", r"gnu gpl", "", "gpl"),
    ("gfdl-1.3", r"gnu free documentation licen[sc]e (?:version |v)?1 3", r"gfdl 1 3(?: only| or later)?", "gfdl|free documentation"),
    ("gfdl-1.2", r"gnu free documentation licen[sc]e (?:version |v)?1 2", r"gfdl 1 2(?: only| or later)?", "gfdl|free documentation"),
    ("gfdl", r"(?:gnu free documentation licen[sc]e|gfdl)", "", "gfdl|free documentation"),
    ("apache-2.0", r"apache (?:software )?licen[sc]e (?:version |v)?2(?: 0)?", "apache 2 0", "apache"),
    ("apache-2.0", r"(?:apache 2(?: 0)? licen[sc]e|asl 2 0|al2 0)", "", "apache 2|asl 2 0|al2 0"),
    ("apache-1.1", r"apache (?:software )?licen[sc]e (?:version |v)?1 1", "apache 1 1", "apache"),
    ("apache-1.0", r"apache (?:software )?licen[sc]e (?:version |v)?1(?: 0)?", "apache 1 0", "apache"),
    ("apache", r"apache (?:software )?licen[sc]e", "", "apache"),
    ("mit-0", r"mit no attribution(?: licen[sc]e)?", "mit 0", "mit no attribution"),
    ("mit-modern", r"modern mit licen[sc]e", "mit modern variant", "modern mit"),
    ("mit", r"(?:mit|expat|mit expat|mit x11) licen[sc]e", "mit", "mit licen|expat licen|x11 licen"),
    ("x11", r"x11 licen[sc]e", "x11", "x11"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", "bsd 4 clause", "bsd"),
    ("bsd-3-clause-clear", r"(?:clear bsd|bsd 3 clause clear)(?: licen[sc]e)?", "bsd 3 clause clear", "bsd"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?", "bsd 3 clause", "bsd"),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", "bsd 2 clause", "bsd"),
    ("bsd-1-clause", r"(?:bsd 1 clause|1 clause bsd)(?: licen[sc]e)?", "bsd 1 clause", "bsd"),
    ("0bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)(?: licen[sc]e)?", "0bsd", "bsd"),
    ("bsd", r"bsd (?:style )?licen[sc]e", "", "bsd"),
    ("isc", r"isc licen[sc]e", "isc", "isc licen"),
    ("mpl-2.0", r"(?:mozilla public licen[sc]e|mpl) (?:version |v)?2(?: 0)?", "mpl 2 0", "mozilla public|mpl"),
    ("mpl-1.1", r"(?:mozilla public licen[sc]e|mpl) (?:version |v)?1 1", "mpl 1 1", "mozilla public|mpl"),
    ("mpl-1.0", r"(?:mozilla public licen[sc]e|mpl) (?:version |v)?1(?: 0)?", "mpl 1 0", "mozilla public|mpl"),
    ("mpl", r"mozilla public licen[sc]e", "", "mozilla public|mpl"),
    ("epl-2.0", r"(?:eclipse public licen[sc]e|epl) (?:version |v)?2(?: 0)?", "epl 2 0", "eclipse public|epl"),
    ("epl-1.0", r"(?:eclipse public licen[sc]e|epl) (?:version |v)?1(?: 0)?", "epl 1 0", "eclipse public|epl"),
    ("epl", r"eclipse public licen[sc]e", "", "eclipse public|epl"),
    ("edl-1.0", r"eclipse distribution licen[sc]e(?: version 1 0| v1 0| 1 0)?", "", "eclipse distribution"),
    ("cddl-1.1", r"(?:common development and distribution licen[sc]e|cddl) (?:version |v)?1 1", "cddl 1 1", "cddl|common development and"),
    ("cddl-1.0", r"(?:common development and distribution licen[sc]e|cddl)(?: (?:version |v)?1(?: 0)?)?", "cddl 1 0", "cddl|common development and"),
    ("cpl-1.0", r"common public licen[sc]e(?: (?:version |v)?1 0)?", "cpl 1 0", "common public"),
    ("ipl-1.0", r"ibm public licen[sc]e(?: (?:version |v)?1 0)?", "ipl 1 0", "ibm public"),
    ("eupl-1.2", r"(?:european union public licen[sc]e|eupl) (?:version |v)?1 2", "eupl 1 2", "european union public|eupl"),
    ("eupl-1.1", r"(?:european union public licen[sc]e|eupl) (?:version |v)?1 1", "eupl 1 1", "european union public|eupl"),
    ("eupl", r"european union public licen[sc]e", "", "european union public|eupl"),
    ("artistic-2.0", r"artistic licen[sc]e (?:version |v)?2(?: 0)?", "artistic 2 0", "artistic"),
    ("artistic-1.0", r"artistic licen[sc]e (?:version |v)?1(?: 0)?", r"artistic 1 0(?: perl| cl8)?", "artistic"),
    ("artistic", r"artistic licen[sc]e", "", "artistic"),
    ("bsl-1.0", r"boost software licen[sc]e(?: (?:version |v)?1 0)?", "bsl 1 0", "boost"),
    ("busl-1.1", r"business source licen[sc]e(?: (?:version |v)?1 1)?", "busl 1 1", "business source"),
    ("sspl-1.0", r"(?:server side public licen[sc]e|sspl)(?: (?:version |v)?1(?: 0)?)?", "sspl 1 0", "sspl|server side public"),
    ("elastic-2.0", r"elastic licen[sc]e(?: (?:version |v)?2(?: 0)?)?", "elastic 2 0", "elastic"),
    ("unlicense", r"the unlicense", "unlicense", "unlicense"),
    ("wtfpl", r"(?:do what the fuck you want to public licen[sc]e|wtfpl)", "wtfpl", "wtfpl|do what the fuck"),
    ("zlib-acknowledgement", r"zlib libpng licen[sc]e with acknowledgement", "zlib acknowledgement", "acknowledgement"),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", "zlib"),
    ("libpng-2.0", r"(?:png reference library|libpng) licen[sc]e(?: version 2)?", "libpng 2 0", "libpng licen|png reference"),
    ("ncsa", r"(?:university of illinois )?ncsa (?:open source )?licen[sc]e", "ncsa", "ncsa"),
    ("python-2.0", r"(?:python software foundation|psf|python) licen[sc]e(?: agreement)?(?: (?:version |v)?2)?", r"(?:psf|python) 2 0", "python licen|python software foundation|psf licen"),
    ("php-3.01", r"php licen[sc]e (?:version |v)?3 01", "php 3 01", "php"),
    ("php-3.0", r"php licen[sc]e(?: (?:version |v)?3(?: 0)?)?", "php 3 0", "php"),
    ("ruby", r"ruby licen[sc]e", "ruby", "ruby"),
    ("openssl", r"(?:openssl|ssleay) licen[sc]e", "openssl", "openssl licen|ssleay licen"),
    ("postgresql", r"postgresql licen[sc]e", "postgresql", "postgresql"),
    ("ofl-1.1", r"(?:sil )?open font licen[sc]e(?: (?:version |v)?1 1)?", "ofl 1 1", "open font"),
    ("odbl-1.0", r"(?:open data commons )?open database licen[sc]e(?: (?:version |v)?1 0)?", "odbl 1 0", "open database"),
    ("odc-by-1.0", r"open data commons attribution licen[sc]e(?: (?:version |v)?1 0)?", "odc by 1 0", "open data commons"),
    ("pddl-1.0", r"(?:open data commons )?public domain dedication and licen[sc]e", "pddl 1 0", "public domain dedication"),
    ("cdla-permissive-2.0", r"community data licen[sc]e agreement permissive(?: (?:version )?2 0)?", r"cdla permissive 2 0", "community data"),
    ("cdla-sharing-1.0", r"community data licen[sc]e agreement sharing(?: (?:version )?1 0)?", "cdla sharing 1 0", "community data"),
    ("ms-pl", r"microsoft public licen[sc]e", "ms pl", "microsoft public"),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", "ms rl", "microsoft reciprocal"),
    ("bigscience-openrail-m", r"(?:bigscience )?(?:open rail|openrail)(?: m)? licen[sc]e", "", "rail"),
    ("osl-3.0", r"open software licen[sc]e(?: (?:version |v)?3 0)?", "osl 3 0", "open software"),
    ("afl-3.0", r"academic free licen[sc]e(?: (?:version |v)?3 0)?", "afl 3 0", "academic free"),
    ("upl-1.0", r"universal permissive licen[sc]e(?: (?:version |v)?1 0)?", "upl 1 0", "universal permissive"),
    ("vim", r"vim licen[sc]e", "vim", "vim licen"),
    ("lppl-1.3", r"latex project public licen[sc]e(?: (?:version |v)?1 3[a-c]?)?", r"lppl 1 3[a-c]", "latex project"),
    ("qpl-1.0", r"q public licen[sc]e(?: (?:version )?1 0)?", "qpl 1 0", "q public"),
    ("blueoak-1.0", r"blue oak model licen[sc]e(?: 1 0 0)?", "blueoak 1 0 0", "blue oak"),
    ("mulan-psl-2.0", r"mulan (?:psl|permissive software licen[sc]e)(?: v2| version 2)?", "mulanpsl 2 0", "mulan"),
    ("cecill-2.1", r"cecill(?: free software)? licen[sc]e(?: agreement)?(?: v(?:ersion )?2 1)?", r"cecill 2 1", "cecill"),
    ("json", r"json licen[sc]e", "json", "json licen"),
    ("beerware", r"beer ?ware licen[sc]e", "beerware", "beer"),
]

#: Creative Commons: the ways to say each kind; versions are part of the rule, and of the label.
CC_KINDS = [
    ("cc-by-nc-nd", r"by nc nd", r"attribution non ?commercial no ?deriv(?:ative|ate)?s?(?: works)?"),
    ("cc-by-nc-sa", r"by nc sa", r"attribution non ?commercial share ?alike"),
    ("cc-by-nc", r"by nc", r"attribution non ?commercial"),
    ("cc-by-nd", r"by nd", r"attribution no ?deriv(?:ative|ate)?s?(?: works)?"),
    ("cc-by-sa", r"by sa", r"attribution share ?alike"),
    ("cc-by", r"by", r"attribution"),
]
CC_VERSIONS = ["4.0", "3.0", "2.5", "2.0", "1.0"]

# label, notice, a keyword that every match holds
NOTICES = [
    ("mit-0", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided", "to deal in the software"),
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?", "free of charge to any person"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "for any purpose with or without fee"),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", "and without fee"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "without a written agreement"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "all advertising materials"),
    ("bsd-3-clause", r"neither the name of (?:the )?(?:[^ ]+ ){1,12}?nor the names of (?:its|the|their) contributors may be used to endorse or promote products", "neither the name of"),
    ("bsd-2-clause", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", "redistributions in binary form"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source"),
    ("apache-2.0", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "you may not use this file except"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "unless required by applicable law"),
    ("agpl-3.0-or-later", r"under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gnu affero general public license as published"),
    ("lgpl-3.0-or-later", r"under the terms of the gnu lesser general public license as published by the free software foundation either version 3(?: 0)? of the license or at your option any later version", "gnu lesser general public license as published"),
    ("lgpl-2.1-or-later", r"under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version", "gnu lesser general public license as published"),
    ("lgpl-2.0-or-later", r"under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version", "gnu library general public license as published"),
    ("gpl-3.0-or-later", r"under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gnu general public license as published"),
    ("gpl-2.0-or-later", r"under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "gnu general public license as published"),
    ("gpl-2.0", r"under the terms of the gnu general public license version 2 as published by the free software foundation", "general public license version 2 as published"),
    ("gpl-3.0", r"under the terms of the gnu general public license version 3 as published by the free software foundation", "general public license version 3 as published"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "this program is free software"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "this library is free software"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "free documentation license"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0", "this source code form is subject"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1", "the contents of this file are subject"),
    ("mpl-1.0", r"the contents of this file are subject to the mozilla public license version 1 0", "the contents of this file are subject"),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development and distribution license", "the contents of this file are subject"),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0", "the accompanying materials are made available"),
    ("epl-1.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "the accompanying materials are made available"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("bsl-1.0", r"boost software license version 1 0 august 17th 2003", "august 17th 2003"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable"),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "altered source versions"),
    ("wtfpl", r"you just do what the fuck you want to", "do what the fuck"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license version 1 1", "this font software is licensed"),
    ("cc0-1.0", r"to the extent possible under law (?:[^ ]+ ){1,12}?(?:has|have) (?:waived|dedicated) all copyright", "to the extent possible under law"),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer", "buy me a beer"),
    ("json", r"the software shall be used for good not evil", "shall be used for good"),
    ("vim", r"there are no restrictions on distributing unmodified copies of vim", "unmodified copies of vim"),
    ("busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", "non production use of the licensed work"),
    ("proprietary", r"all rights reserved (?:no part of this (?:[^ ]+ ){1,6}?may be (?:reproduced|copied)|unauthori[sz]ed (?:copying|reproduction|use))", "all rights reserved"),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)(?: information)?", "proprietary"),
    ("proprietary", r"unauthori[sz]ed (?:copying|distribution|reproduction) of this (?:file|software|work|document) (?:via any medium )?is strictly prohibited", "is strictly prohibited"),
    ("non-commercial", r"(?:for )?non ?commercial (?:use|purposes) only", "commercial"),
    ("research-only", r"(?:for )?(?:academic|research) (?:use|purposes) only", "only"),
    ("public-domain", r"(?:dedicated to|released (?:in)?to|placed in(?:to)?) the public domain", "public domain"),
    ("public-domain", r"this work is in the public domain", "public domain"),
    ("public-domain", r"no rights reserved", "no rights reserved"),
]

# label, address, a keyword that every match holds
LINKS = [
    ("apache-2.0", r"apache org licenses license 2 0", "apache org licenses"),
    ("apache", r"apache org licenses", "apache org licenses"),
    ("mit", r"opensource org (?:licenses?|licence) (?:mit|mit license php)", "opensource org"),
    ("bsd-3-clause", r"opensource org licenses? bsd 3 clause", "opensource org"),
    ("bsd-2-clause", r"opensource org licenses? bsd 2 clause", "opensource org"),
    ("bsd", r"opensource org licenses? bsd license php", "opensource org"),
    ("isc", r"opensource org licenses? isc", "opensource org"),
    ("artistic-2.0", r"opensource org licenses? artistic (?:license )?2 0", "opensource org"),
    ("epl-2.0", r"eclipse org (?:legal )?epl(?: v)? ?2(?: ?0)?", "eclipse org"),
    ("epl-1.0", r"eclipse org legal epl v10", "eclipse org"),
    ("mpl-2.0", r"mozilla org (?:en us )?mpl 2 0", "mozilla org"),
    ("mpl", r"mozilla org (?:en us )?mpl", "mozilla org"),
    ("agpl-3.0", r"gnu org licenses agpl(?: 3 0)?", "gnu org licenses"),
    ("lgpl-3.0", r"gnu org licenses lgpl(?: 3 0)?", "gnu org licenses"),
    ("lgpl-2.1", r"gnu org licenses (?:old licenses )?lgpl 2 1", "gnu org licenses"),
    ("gpl-3.0", r"gnu org licenses gpl 3 0", "gnu org licenses"),
    ("gpl-2.0", r"gnu org licenses (?:old licenses )?gpl 2 0", "gnu org licenses"),
    ("gpl", r"gnu org (?:copyleft|licenses) gpl", "gnu org"),
    ("gfdl", r"gnu org (?:copyleft|licenses) fdl", "gnu org"),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0", "creativecommons org"),
    ("public-domain", r"creativecommons org publicdomain mark 1 0", "creativecommons org"),
    ("unlicense", r"unlicense org", "unlicense org"),
    ("bsl-1.0", r"boost org license 1 0", "boost org"),
    ("ofl-1.1", r"scripts sil org ofl", "scripts sil org"),
    ("odbl-1.0", r"opendatacommons org licenses odbl", "opendatacommons org"),
    ("odc-by-1.0", r"opendatacommons org licenses by", "opendatacommons org"),
    ("pddl-1.0", r"opendatacommons org licenses pddl", "opendatacommons org"),
    ("wtfpl", r"wtfpl net", "wtfpl net"),
    ("python-2.0", r"docs python org (?:[23] )?license", "docs python org"),
    ("php-3.01", r"php net license 3 01", "php net license"),
    ("zlib", r"zlib net zlib license", "zlib net"),
    ("elastic-2.0", r"elastic co licensing elastic license", "elastic co"),
    ("sspl-1.0", r"mongodb com (?:legal )?licensing server side public license", "mongodb com"),
    ("eupl-1.2", r"joinup ec europa eu (?:[^ ]+ ){0,6}?eupl", "joinup ec europa"),
]

#: The phrases of the contract and their labels (fixed values).
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

TAG = r"spdx license identifier (?:(?:[^ ]+ ){{1,12}}?(?:or|and) )?{0}"
GRANT = (r"(?:licen[sc]ed|released|distributed|available|published|provided|shared|covered|governed|redistributed|offered) "
         r"(?:to you )?(?:under|by|with)(?: the)?(?: terms(?: and conditions)? of)?(?: the| a| an)? {0}")
#: How far each kind of rule is to be trusted: the score of a text is that of its best detection.
TRUST = {"tag": 0.99, "notice": 0.95, "link": 0.9, "grant": 0.9, "name": 0.7, "phrase": 0.6}


@dataclass(frozen=True)
class Rule:
    """``keys``: pieces of normalised text of which every match holds one; a text with none of them needs no search.
    ``pattern`` is compiled where it is first needed: few rules of a task ever pass their gate."""

    label: str
    kind: str
    keys: tuple[bytes, ...]
    pattern: bytes


def _rule(label: str, kind: str, pattern: str, keys: str) -> Rule:
    return Rule(label, kind, tuple(keys.encode().split(b"|")), rf"(?<= )(?:{pattern})(?= )".encode())


def _creative_commons() -> list[tuple[str, str, str, str]]:
    """Creative Commons kinds with each version, then without, as rows of LICENSES."""
    rows = []
    for kind, short, long in CC_KINDS:
        said = rf"(?:cc {short}|creative commons (?:{short}|{long}))(?: licen[sc]e)?"
        for version in CC_VERSIONS:
            digits = version.replace(".", " ")
            number = rf"(?:version |v|v )?{digits}(?: (?:international|unported|generic))?(?: licen[sc]e)?"
            rows.append((f"{kind}-{version}", f"{said} {number}", f"cc {short} {digits}", " cc by|creative commons"))
        rows.append((kind, said, "", " cc by|creative commons"))
    return rows


def rules() -> tuple[Rule, ...]:
    """All rules, first ones first."""
    named = [*_creative_commons(), ("cc0-1.0", r"(?:cc0|cc zero|creative commons zero)(?: (?:version |v)?1 0)?(?: universal)?", "cc0 1 0", " cc0| cc zero|creative commons zero"), *LICENSES]
    out = [_rule(label, "tag", TAG.format(f"(?:{tag})"), "spdx license identifier ") for label, _, tag, _ in named if tag]
    out += [_rule(label, "notice", text, key) for label, text, key in NOTICES]
    for kind, short, _ in CC_KINDS:
        for version in CC_VERSIONS:
            out.append(_rule(f"{kind}-{version}", "link", rf"creativecommons org licenses {short} {version.replace('.', ' ')}", "creativecommons org"))
    out += [_rule(label, "link", text, key) for label, text, key in LINKS]
    out += [_rule(label, "grant", GRANT.format(f"(?:{name})"), key) for label, name, _, key in named]
    out += [_rule(label, "name", name, key) for label, name, _, key in named]
    out += [_rule(label, "phrase", phrase, phrase) for label, phrase in PHRASES]
    return tuple(out)

