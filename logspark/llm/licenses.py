"""License scans: ordered signature rules, gated by a keyword prefilter, with overlaps resolved by priority and containment.

A text is lower-cased (A-Z) and cut in words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ joined by single blanks. One Aho-Corasick
scan finds the keywords; only rules with a keyword in the text are tried. Of the detections, a higher priority goes
first, then the longer one; a later detection that lies inside an earlier one, or overlaps one of the same family, is
suppressed. Base phrases are counted by themselves and their labels always stay.

Rules come from two places: SIGNATURES, written by hand from the licenses' sentences, and names, identifiers and
versions of each family as they stand in prose and in identifier lines.

Edge cases: a null or empty text has no words, no labels (empty strings) and score 0; several places of a phrase all
count; equal rows give equal results; an empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from logspark.llm.common import ALNUM, id_text, map_rows

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Family -> (names as they stand in prose, identifiers, versions).
FAMILIES = {
    "mit": (("mit license", "mit licence", "expat license", "x11 license"), ("mit", "x11"), ()),
    "apache": (("apache license", "apache software license", "apache licence"), ("apache",), ("1 0", "1 1", "2 0")),
    "gpl": (("gnu general public license", "gnu gpl", "general public license", "general public licence"), ("gpl",), ("1 0", "2 0", "3 0", "2", "3")),
    "lgpl": (("gnu lesser general public license", "lesser general public license", "gnu library general public license", "gnu lgpl"), ("lgpl",), ("2 0", "2 1", "3 0", "3")),
    "agpl": (("gnu affero general public license", "affero general public license", "gnu agpl"), ("agpl",), ("1 0", "3 0", "3")),
    "gfdl": (("gnu free documentation license",), ("gfdl",), ("1 1", "1 2", "1 3")),
    "bsd": (("bsd license", "berkeley software distribution license", "new bsd license", "simplified bsd license", "modified bsd license", "bsd 3 clause license", "bsd 2 clause license"), ("bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "0bsd"), ()),
    "isc": (("isc license", "internet systems consortium license"), ("isc",), ()),
    "mpl": (("mozilla public license",), ("mpl",), ("1 0", "1 1", "2 0")),
    "epl": (("eclipse public license",), ("epl",), ("1 0", "2 0")),
    "cddl": (("common development and distribution license",), ("cddl",), ("1 0", "1 1")),
    "cpl": (("common public license",), ("cpl",), ("1 0",)),
    "eupl": (("european union public licence", "european union public license"), ("eupl",), ("1 0", "1 1", "1 2")),
    "artistic": (("artistic license", "perl artistic license"), ("artistic",), ("1 0", "2 0")),
    "boost": (("boost software license",), ("bsl",), ("1 0",)),
    "zlib": (("zlib license", "zlib libpng license"), ("zlib",), ()),
    "unlicense": (("the unlicense", "unlicense license"), ("unlicense",), ()),
    "wtfpl": (("do what the fuck you want to public license",), ("wtfpl",), ("2",)),
    "cc0": (("creative commons zero", "cc0 public domain dedication"), ("cc0",), ("1 0",)),
    "cc by": (("creative commons attribution license", "creative commons attribution"), ("cc by",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "cc by sa": (("creative commons attribution sharealike license", "creative commons attribution share alike"), ("cc by sa",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "cc by nc": (("creative commons attribution noncommercial license", "creative commons attribution non commercial"), ("cc by nc",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    "python": (("python software foundation license", "psf license"), ("psf", "python"), ("2 0", "2")),
    "php": (("php license",), ("php",), ("3 0", "3 01")),
    "ruby": (("ruby license",), ("ruby",), ()),
    "openssl": (("openssl license",), ("openssl",), ()),
    "postgresql": (("postgresql license",), ("postgresql",), ()),
    "ofl": (("sil open font license", "open font license"), ("ofl",), ("1 0", "1 1")),
    "odbl": (("open database license", "open data commons open database license"), ("odbl",), ("1 0",)),
    "ms pl": (("microsoft public license",), ("ms pl",), ()),
    "ms rl": (("microsoft reciprocal license",), ("ms rl",), ()),
    "sspl": (("server side public license",), ("sspl",), ("1 0", "1")),
    "busl": (("business source license",), ("busl",), ("1 1",)),
    "elastic": (("elastic license",), ("elastic",), ("2 0",)),
    "ncsa": (("university of illinois ncsa open source license",), ("ncsa",), ()),
    "vim": (("vim license",), ("vim",), ()),
    "proprietary": (("proprietary license", "commercial license agreement", "end user license agreement"), (), ()),
}
# Signatures written by hand, each from a sentence of a license's text or notice:
# (label, keyword, pattern, priority, relevance).
SIGNATURES = (
    ("mit", "obtaining a copy", r"permission is hereby granted free of charge to any person obtaining a copy(?: of this software and associated documentation files)?", 9, 1.0),
    ("mit", "substantial portions of the software", r"the above copyright notice and this permission notice (?:\w+ ){0,6}shall be included in all copies or substantial portions of the software", 9, 0.95),
    ("mit x11", "shall not be used in advertising", r"except as contained in this notice the names? of (?:\w+ ){1,10}shall not be used in advertising", 9, 0.95),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted", 9, 1.0),
    ("bsd 2 clause", "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", 9, 0.9),
    ("bsd 3 clause", "used to endorse or promote products", r"(?:neither )?the names? of (?:\w+ ){1,14}may (?:not )?be used to endorse or promote products", 10, 1.0),
    ("bsd 4 clause", "all advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 10, 1.0),
    ("isc", "and or distribute this software for any purpose", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?: provided that the above copyright notice)?", 9, 1.0),
    ("ntp", "distribute this software and its documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted", 9, 0.95),
    ("postgresql", "without a written agreement", r"for any purpose without fee and without a written agreement is hereby granted", 10, 1.0),
    ("apache", "except in compliance with the license", r"you may not use this file except in compliance with the license", 8, 0.95),
    ("apache 2 0", "apache org licenses license 2 0", r"(?:you may obtain a copy of the license at )?https? www apache org licenses license 2 0", 10, 1.0),
    ("apache 2 0", "agreed to in writing", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 9, 0.95),
    ("apache 1 1", "developed by the apache software foundation", r"this product includes software developed by the apache software foundation", 9, 0.9),
    ("gpl", "modify it under the terms of the gnu general public license", r"you can redistribute it and or modify it under the terms of the gnu general public license", 9, 1.0),
    ("gpl", "a copy of the gnu general public license", r"you should have received a copy of the gnu general public license", 8, 0.9),
    ("gpl", "general public license for more details", r"see the gnu general public license for more details", 8, 0.9),
    ("gpl 2", "either version 2 of the license", r"either version 2 of the license or at your option any later version", 9, 0.95),
    ("gpl 3", "either version 3 of the license", r"either version 3 of the license or at your option any later version", 9, 0.95),
    ("gpl", "changing it is not allowed", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", 7, 0.7),
    ("lgpl", "modify it under the terms of the gnu lesser general public license", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license", 10, 1.0),
    ("lgpl", "modify it under the terms of the gnu library general public license", r"you can redistribute it and or modify it under the terms of the gnu library general public license", 10, 1.0),
    ("lgpl", "a copy of the gnu lesser general public license", r"you should have received a copy of the gnu lesser general public license", 9, 0.9),
    ("agpl", "modify it under the terms of the gnu affero general public license", r"you can redistribute it and or modify it under the terms of the gnu affero general public license", 10, 1.0),
    ("agpl", "a copy of the gnu affero general public license", r"you should have received a copy of the gnu affero general public license", 9, 0.9),
    ("gfdl", "modify this document under the terms", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 10, 1.0),
    ("gfdl", "no invariant sections", r"with no invariant sections no front cover texts and no back cover texts", 8, 0.9),
    ("mpl", "subject to the terms of the mozilla public license", r"this source code form is subject to the terms of the mozilla public license", 9, 1.0),
    ("mpl 1 1", "subject to the mozilla public license", r"the contents of this file are subject to the mozilla public license version 1 1", 10, 1.0),
    ("mpl 2 0", "a copy of the mpl was not distributed", r"if a copy of the mpl was not distributed with this file you can obtain one at", 9, 0.95),
    ("epl", "accompanying materials are made available under", r"this program and the accompanying materials are made available under the terms of the eclipse public license", 10, 1.0),
    ("cddl", "terms of the common development and distribution license", r"the contents of this file are subject to the terms of the common development and distribution license", 10, 1.0),
    ("cpl", "terms of the common public license", r"made available under the terms of the common public license", 10, 1.0),
    ("eupl", "licensed under the eupl", r"licensed under the eupl(?: version 1 [12])?(?: or as soon they will be approved)?", 9, 1.0),
    ("artistic", "same terms as perl itself", r"redistribute it and or modify it under the same terms as perl itself", 9, 0.95),
    ("artistic 2 0", "terms of the artistic license 2 0", r"under the terms of the artistic license 2 0", 9, 1.0),
    ("boost", "any person or organization obtaining a copy", r"permission is hereby granted free of charge to any person or organization obtaining a copy", 10, 1.0),
    ("boost", "17th august 2003", r"boost software license version 1 0 (?:\w+ ){0,2}17th august 2003", 9, 1.0),
    ("zlib", "without any express or implied warranty", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", 8, 0.95),
    ("zlib", "and redistribute it freely", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", 9, 1.0),
    ("unlicense", "free and unencumbered software", r"this is free and unencumbered software released into the public domain", 9, 1.0),
    ("unlicense", "publish use compile sell or distribute", r"anyone is free to copy modify publish use compile sell or distribute this software", 9, 1.0),
    ("wtfpl", "what the fuck you want to", r"you just do what the fuck you want to", 9, 1.0),
    ("cc0", "has waived all copyright", r"has waived all copyright and related or neighbou?ring rights", 8, 0.9),
    ("cc0", "publicdomain zero 1 0", r"creativecommons org publicdomain zero 1 0", 10, 1.0),
    ("cc by", "creativecommons org licenses by", r"creativecommons org licenses by(?: [1-4] [05])?", 8, 0.95),
    ("cc by sa", "creativecommons org licenses by sa", r"creativecommons org licenses by sa(?: [1-4] [05])?", 9, 1.0),
    ("cc by nc", "creativecommons org licenses by nc", r"creativecommons org licenses by nc(?: [1-4] [05])?", 9, 1.0),
    ("cc by nc sa", "creativecommons org licenses by nc sa", r"creativecommons org licenses by nc sa(?: [1-4] [05])?", 10, 1.0),
    ("cc by nd", "creativecommons org licenses by nd", r"creativecommons org licenses by nd(?: [1-4] [05])?", 9, 1.0),
    ("cc by nc nd", "creativecommons org licenses by nc nd", r"creativecommons org licenses by nc nd(?: [1-4] [05])?", 10, 1.0),
    ("cc", "some rights reserved", r"some rights reserved", 3, 0.5),
    ("python", "psf hereby grants licensee", r"psf hereby grants licensee a nonexclusive royalty free world wide license", 9, 1.0),
    ("php", "includes php software", r"this product includes php software freely available from", 9, 0.95),
    ("openssl", "developed by the openssl project", r"this product includes software developed by the openssl project", 9, 0.95),
    ("openssl", "original ssleay license", r"original ssleay license", 8, 0.9),
    ("ofl", "this font software is licensed under", r"this font software is licensed under the sil open font license", 9, 1.0),
    ("ofl", "reserved font name", r"with reserved font names?", 6, 0.8),
    ("odbl", "database contents license", r"any rights in individual contents of the database are licensed under the database contents license", 9, 1.0),
    ("ms pl", "you bear the risk of using it", r"the software is licensed as is you bear the risk of using it", 7, 0.8),
    ("sspl", "to third parties as a service", r"make the functionality of the program or a modified version available to third parties as a service", 9, 1.0),
    ("busl", "make non production use", r"copy modify create derivative works redistribute and make non production use of the licensed work", 9, 1.0),
    ("elastic", "as a hosted or managed service", r"you may not provide the software to third parties as a hosted or managed service", 9, 1.0),
    ("ncsa", "deal with the software without restriction", r"to deal with the software without restriction", 8, 0.9),
    ("vim", "vim is charityware", r"vim is charityware", 8, 0.95),
    ("icu", "icu license", r"icu license icu 1 8 1 and later", 8, 0.95),
    ("json", "used for good not evil", r"the software shall be used for good not evil", 9, 1.0),
    ("beerware", "you can buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer", 9, 1.0),
    ("blessing", "may you do good and not evil", r"may you do good and not evil", 8, 0.95),
    ("ecl", "educational community license", r"educational community license(?: version [12] 0)?", 7, 0.9),
    ("afl", "academic free license", r"academic free license(?: version [123] \d)?", 7, 0.9),
    ("osl", "open software license", r"open software license(?: version [123] \d)?", 7, 0.9),
    ("qpl", "q public license", r"(?:the )?q public license(?: version 1 0)?", 7, 0.9),
    ("sleepycat", "how to obtain complete source code", r"redistributions in any form must be accompanied by information on how to obtain complete source code", 9, 1.0),
    ("w3c", "w3c software notice and license", r"w3c software notice and license", 8, 0.95),
    ("upl", "universal permissive license", r"(?:the )?universal permissive license(?: upl)?(?: version 1 0)?", 8, 0.95),
    ("hpnd", "historical permission notice and disclaimer", r"historical permission notice and disclaimer", 8, 0.95),
    ("public domain", "in the public domain", r"(?:is|has been placed|was placed|are) in the public domain", 6, 0.7),
    ("public domain", "to the public domain", r"(?:dedicated|dedicates? (?:\w+ ){1,4}) ?to the public domain", 6, 0.8),
    ("proprietary", "unauthorized copying", r"(?:all rights reserved )?unauthorized copying of this (?:file|software|work|program)(?: via any medium)? is strictly prohibited", 8, 0.95),
    ("proprietary", "confidential and proprietary information", r"(?:is|contains|are) (?:the )?confidential and proprietary information of", 8, 0.95),
    ("proprietary", "unpublished rights reserved", r"unpublished rights reserved under the copyright laws", 8, 0.95),
    ("proprietary", "may be reproduced", r"no part of this (?:publication|document|software|work|book) may be reproduced", 7, 0.8),
    ("proprietary", "legal agreement between you", r"is a legal agreement between you (?:\w+ ){0,6}and", 6, 0.8),
    ("proprietary", "reverse engineer decompile", r"(?:may|shall|will) not (?:\w+ ){0,4}reverse engineer decompile(?: or)? disassemble", 7, 0.8),
    ("noncommercial", "non commercial", r"for non commercial (?:use|purposes) only", 5, 0.7),
    ("noncommercial", "noncommercial", r"for noncommercial (?:use|purposes) only", 5, 0.7),
    ("noncommercial", "research purposes only", r"for (?:academic |scientific )?research purposes only", 5, 0.7),
    ("mit", "to deal in the software without restriction", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell", 9, 1.0),
    ("mit", "claim damages or other liability", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", 8, 0.9),
    ("mit", "warranties of merchantability fitness", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness", 7, 0.8),
    ("mit 0", "the software without restriction including", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided", 11, 1.0),
    ("bsd", "procurement of substitute goods or services", r"procurement of substitute goods or services loss of use data or profits or business interruption", 8, 0.9),
    ("bsd", "provided by the copyright holders and contributors", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties", 8, 0.9),
    ("bsd", "redistributions of source code must retain", r"redistributions of source code must retain the above copyright notice", 8, 0.9),
    ("bsd", "provided by the regents and contributors", r"this software is provided by the regents and contributors as is", 9, 0.95),
    ("bsd 0 clause", "performance of this software", r"arising out of or in connection with the use or performance of this software", 6, 0.7),
    ("bsd 3 clause clear", "no express or implied licenses to any", r"no express or implied licenses to any party s patent rights are granted by this license", 10, 1.0),
    ("bsd source code", "neither the name of the university", r"neither the name of the university nor the names of its contributors", 9, 0.95),
    ("isc", "loss of use data or profits whether", r"special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract", 8, 0.9),
    ("isc", "disclaims all warranties with regard", r"the author disclaims all warranties with regard to this software including all implied warranties", 8, 0.9),
    ("apache 2 0", "each contributor hereby grants to you a perpetual", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", 9, 1.0),
    ("apache 2 0", "derivative works a copy of this license", r"you must give any other recipients of the work or derivative works a copy of this license", 9, 0.95),
    ("apache 2 0", "licensed to the apache software foundation", r"licensed to the apache software foundation asf under one or more contributor license agreements", 10, 1.0),
    ("apache 2 0", "reproduction and distribution", r"terms and conditions for use reproduction and distribution 1 definitions", 9, 0.95),
    ("apache 2 0", "cross claim or counterclaim in a lawsuit", r"including a cross claim or counterclaim in a lawsuit alleging that the work", 9, 0.95),
    ("apache 1 0", "redistributions of any form whatsoever", r"redistributions of any form whatsoever must retain the following acknowledge?ment", 9, 0.9),
    ("apache 1 1", "may apache appear in their name", r"nor may apache appear in their name without prior written permission", 10, 1.0),
    ("gpl", "protect your rights with two steps", r"we protect your rights with two steps 1 copyright the software", 9, 0.95),
    ("gpl 2", "work based on the program", r"you may modify your copy or copies of the program or any portion of it thus forming a work based on the program", 9, 1.0),
    ("gpl 2", "accompany it with the complete corresponding", r"accompany it with the complete corresponding machine readable source code", 8, 0.9),
    ("gpl 2", "51 franklin street fifth floor", r"free software foundation inc 51 franklin street fifth floor boston", 8, 0.85),
    ("gpl 2", "59 temple place suite 330", r"free software foundation inc 59 temple place suite 330 boston", 8, 0.85),
    ("gpl 2", "675 mass ave cambridge", r"free software foundation inc 675 mass ave cambridge", 8, 0.85),
    ("gpl 3", "convey covered works to others for the sole purpose", r"you may convey covered works to others for the sole purpose of having them make modifications exclusively for you", 9, 1.0),
    ("gpl 3", "no covered work shall be deemed part", r"no covered work shall be deemed part of an effective technological measure", 9, 1.0),
    ("gpl 3", "installation information", r"the requirement to provide installation information does not include a requirement", 8, 0.9),
    ("gpl", "freedom to share and change it", r"the licenses for most software are designed to take away your freedom to share and change it", 9, 0.95),
    ("gpl", "free copyleft license for software", r"is a free copyleft license for software and other kinds of works", 9, 0.95),
    ("gpl", "how to apply these terms to your new programs", r"how to apply these terms to your new programs", 7, 0.8),
    ("gpl", "but without any warranty without even", r"in the hope that it will be useful but without any warranty without even the implied warranty of merchantability", 7, 0.8),
    ("gpl classpath exception", "linking this library statically or dynamically", r"linking this library statically or dynamically with other modules is making a combined work based on this library", 10, 1.0),
    ("gpl autoconf exception", "contains a configuration script generated by autoconf", r"distribute this file as part of a program that contains a configuration script generated by autoconf", 10, 1.0),
    ("gpl bison exception", "skeleton", r"you may create a larger work that contains part or all of the bison parser skeleton", 10, 1.0),
    ("gcc runtime exception", "gcc runtime library exception", r"gcc runtime library exception", 10, 1.0),
    ("lgpl", "designed to work with the library", r"is designed to work with the library by being compiled or linked with it is called a work that uses the library", 9, 1.0),
    ("lgpl 3", "terms and conditions of version 3 of the gnu general", r"incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions", 10, 1.0),
    ("lgpl", "successor of the gnu library public license", r"it also counts as the successor of the gnu library public license", 9, 0.95),
    ("agpl", "remote network interaction", r"remote network interaction use with the gnu general public license", 9, 1.0),
    ("agpl", "interacting with it remotely through a computer network", r"must prominently offer all users interacting with it remotely through a computer network", 9, 1.0),
    ("gfdl", "a secondary section is a named appendix", r"a secondary section is a named appendix or a front matter section", 9, 1.0),
    ("gfdl", "preserve in that license notice the full lists", r"preserve in that license notice the full lists of invariant sections and required cover texts", 9, 1.0),
    ("mpl 1 1", "initial developer of the original code", r"the initial developer of the original code is", 8, 0.9),
    ("mpl 1 1", "alternatively the contents of this file may be used", r"alternatively the contents of this file may be used under the terms of either the gnu general public license", 9, 0.95),
    ("mpl 2 0", "incompatible with secondary licenses", r"this source code form is incompatible with secondary licenses as defined by the mozilla public license", 10, 1.0),
    ("mpl 2 0", "covered software is provided under this license", r"covered software is provided under this license on an as is basis", 9, 0.95),
    ("epl", "secondary licenses when the conditions", r"this source code may also be made available under the following secondary licenses when the conditions for such availability", 9, 1.0),
    ("epl", "any use reproduction or distribution of the program constitutes", r"any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement", 8, 0.9),
    ("edl", "eclipse distribution license", r"eclipse distribution license(?: version 1 0| v ?1 0)?", 8, 0.95),
    ("cddl", "covered software under the terms of this license", r"you may distribute the executable form of the covered software under the terms of this license", 9, 0.95),
    ("cddl", "cddl header start", r"cddl header start", 8, 0.95),
    ("ipl", "ibm public license", r"(?:the )?ibm public license(?: version 1 0)?", 8, 0.95),
    ("apsl", "apple public source license", r"(?:the )?apple public source license(?: version [12] [012])?", 8, 0.95),
    ("npl", "netscape public license", r"(?:the )?netscape public license(?: version 1 [01])?", 8, 0.95),
    ("spl", "sun public license", r"(?:the )?sun public license(?: version 1 0)?", 8, 0.95),
    ("sissl", "sun industry standards source license", r"sun industry standards source license", 8, 0.95),
    ("rpsl", "realnetworks public source license", r"realnetworks public source license", 8, 0.95),
    ("nosl", "netizen open source license", r"netizen open source license", 8, 0.95),
    ("nasa", "nasa open source agreement", r"nasa open source agreement(?: version 1 3)?", 8, 0.95),
    ("lppl", "latex project public license", r"conditions of the latex project public license", 9, 1.0),
    ("lppl", "lppl maintenance status", r"this work has the lppl maintenance status", 9, 1.0),
    ("lppl", "latex project public license", r"(?:the )?latex project public license(?: version 1 [0123])?", 7, 0.9),
    ("cecill", "cecill", r"(?:governed by|under) (?:the )?cecill(?: b| c)? license", 8, 0.95),
    ("clarified artistic", "clarified artistic license", r"(?:the )?clarified artistic license", 8, 0.95),
    ("artistic", "intent of this document is to state the conditions", r"the intent of this document is to state the conditions under which a package may be copied", 9, 1.0),
    ("artistic", "reasonable copying fee", r"you may charge a reasonable copying fee for any distribution of this package", 9, 0.95),
    ("boost", "works are solely in the form of machine executable", r"unless such copies or derivative works are solely in the form of machine executable object code", 10, 1.0),
    ("zlib", "the origin of this software must not be misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", 9, 1.0),
    ("zlib", "altered source versions must be plainly marked", r"altered source versions must be plainly marked as such and must not be misrepresented", 9, 1.0),
    ("libpng", "png reference library", r"the png reference library is supplied as is", 9, 1.0),
    ("libtiff", "sam leffler and silicon graphics", r"the names of sam leffler and silicon graphics may not be used", 10, 1.0),
    ("ijg", "independent jpeg group", r"this software is based in part on the work of the independent jpeg group", 9, 1.0),
    ("freetype", "freetype project license", r"(?:the )?freetype project license", 8, 0.95),
    ("unicode", "unicode inc license agreement", r"unicode inc license agreement data files and software", 9, 1.0),
    ("unicode", "unicode data files and any associated documentation", r"obtaining a copy of the unicode data files and any associated documentation", 10, 1.0),
    ("python", "beopen python open source license agreement", r"beopen python open source license agreement", 9, 1.0),
    ("python", "psf is making python available to licensee", r"psf is making python available to licensee on an as is basis", 9, 1.0),
    ("php", "products derived from this software may not be called php", r"products derived from this software may not be called php", 9, 1.0),
    ("ruby", "you may distribute the software in object code or binary form", r"you may distribute the software in object code or binary form provided that you do at least one of the following", 9, 1.0),
    ("openssl", "cryptographic software written by eric young", r"this product includes cryptographic software written by eric young", 9, 0.95),
    ("postgresql", "university of california be liable to any party", r"in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages", 9, 0.95),
    ("tcl", "hereby grant permission to use copy modify distribute and license", r"the authors hereby grant permission to use copy modify distribute and license this software", 9, 1.0),
    ("ofl", "goals of the open font license", r"the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects", 9, 1.0),
    ("ofl", "neither the font software nor any of its individual components", r"neither the font software nor any of its individual components in original or modified versions may be sold by itself", 9, 1.0),
    ("bitstream vera", "obtaining a copy of the fonts", r"obtaining a copy of the fonts accompanying this license", 9, 0.95),
    ("odbl", "opendatacommons org licenses odbl", r"opendatacommons org licenses odbl(?: 1 0)?", 9, 1.0),
    ("odc by", "opendatacommons org licenses by", r"opendatacommons org licenses by(?: 1 0)?", 9, 1.0),
    ("pddl", "opendatacommons org licenses pddl", r"opendatacommons org licenses pddl(?: 1 0)?", 9, 1.0),
    ("pddl", "public domain dedication and license", r"(?:open data commons )?public domain dedication and license", 8, 0.95),
    ("cdla permissive", "community data license agreement permissive", r"community data license agreement permissive(?: version [12] 0)?", 8, 0.95),
    ("cdla sharing", "community data license agreement sharing", r"community data license agreement sharing(?: version 1 0)?", 8, 0.95),
    ("ogl uk", "open government licence", r"(?:the )?open government licence(?: v[123] 0| version [123] 0)?", 8, 0.95),
    ("cc0", "the person who associated a work with this deed", r"the person who associated a work with this deed has dedicated the work to the public domain", 9, 1.0),
    ("cc by", "you must give appropriate credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made", 7, 0.85),
    ("cc by sa", "under the same license as the original", r"if you remix transform or build upon the material you must distribute your contributions under the same license as the original", 8, 0.9),
    ("cc by nc", "use the material for commercial purposes", r"you may not use the material for commercial purposes", 7, 0.85),
    ("cc by nd", "you may not distribute the modified material", r"if you remix transform or build upon the material you may not distribute the modified material", 8, 0.9),
    ("cc", "creative commons corporation is not a law firm", r"creative commons corporation is not a law firm and does not provide legal services", 8, 0.9),
    ("cc", "this creative commons public license", r"under the terms of this creative commons public license", 8, 0.9),
    ("ms rl", "for any file you distribute that contains code from the software", r"for any file you distribute that contains code from the software in source code or binary format", 9, 1.0),
    ("ms lpl", "microsoft limited public license", r"microsoft limited public license", 8, 0.95),
    ("microsoft eula", "microsoft software license terms", r"microsoft software license terms", 8, 0.95),
    ("busl", "change date", r"effective on the change date or the fourth anniversary of the first publicly available distribution", 9, 1.0),
    ("busl", "additional use grant", r"licensor may make an additional use grant above permitting limited production use", 9, 1.0),
    ("elastic", "license key functionality", r"you may not move change disable or circumvent the license key functionality in the software", 9, 1.0),
    ("commons clause", "commons clause", r"commons clause license condition(?: v1 0)?", 9, 1.0),
    ("commons clause", "does not grant to you the right to sell", r"the license does not grant to you the right to sell the software", 9, 0.95),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|strict|perimeter|internal use|free trial) license", 9, 1.0),
    ("prosperity", "prosperity public license", r"(?:the )?prosperity public license", 8, 0.95),
    ("parity", "parity public license", r"(?:the )?parity public license", 8, 0.95),
    ("blue oak", "blue oak model license", r"(?:the )?blue oak model license", 8, 0.95),
    ("mulan", "mulan permissive software license", r"mulan permissive software license(?: version [12])?", 8, 0.95),
    ("anti 996", "anti 996 license", r"(?:the )?anti 996 license", 8, 0.95),
    ("hippocratic", "hippocratic license", r"(?:the )?hippocratic license(?: version [123] \d)?", 8, 0.95),
    ("rail", "responsible ai license", r"(?:bigscience |creativeml )?(?:open )?responsible ai license", 8, 0.95),
    ("openrail", "openrail m", r"(?:creativeml |bigscience |bigcode )?openrail m(?: license)?", 8, 0.95),
    ("llama", "community license agreement", r"(?:the )?llama [234](?: \d)? community license agreement", 8, 0.95),
    ("intel", "intel simplified software license", r"intel simplified software license", 8, 0.95),
    ("nvidia", "nvidia software license agreement", r"(?:nvidia software license agreement|license agreement for nvidia software development kits)", 8, 0.95),
    ("oracle bcl", "oracle binary code license agreement", r"oracle binary code license agreement", 8, 0.95),
    ("oracle otn", "oracle technology network license agreement", r"oracle technology network license agreement", 8, 0.95),
    ("x consortium", "x consortium", r"except as contained in this notice the name of the x consortium shall not be used", 10, 1.0),
    ("xfree86", "xfree86 project", r"this product includes software developed by the xfree86 project", 9, 0.95),
    ("eudatagrid", "eu datagrid software license", r"eu datagrid software license", 8, 0.95),
    ("entessa", "entessa public license", r"entessa public license", 8, 0.95),
    ("fair", "usage of the works is permitted", r"usage of the works is permitted provided that this instrument is retained with the works", 9, 1.0),
    ("fsfap", "copying and distribution of this file with or without modification", r"copying and distribution of this file with or without modification are permitted in any medium without royalty", 9, 1.0),
    ("fsful", "free software foundation gives unlimited permission", r"free software foundation gives unlimited permission to copy", 9, 1.0),
    ("glide", "3dfx glide", r"3dfx glide source code general public license", 9, 1.0),
    ("nlpl", "no limit public license", r"no limit public license", 8, 0.95),
    ("ncgl uk", "non commercial government licence", r"non commercial government licence", 8, 0.95),
    ("qpl", "you may copy and distribute the software in unmodified form provided", r"you may copy and distribute the software in unmodified form provided that the entire package", 9, 1.0),
    ("smlnj", "standard ml of new jersey", r"standard ml of new jersey copyright (?:notice|license)", 8, 0.95),
    ("zpl", "zope public license", r"(?:the )?zope public license(?: zpl)?(?: version [12] [01])?", 8, 0.95),
    ("watcom", "sybase open watcom public license", r"sybase open watcom public license", 8, 0.95),
    ("vovida", "vovida software license", r"vovida software license", 8, 0.95),
    ("xnet", "x net license", r"x net license", 6, 0.8),
    ("public domain", "no copyright is claimed", r"no copyright is claimed", 6, 0.7),
    ("public domain", "work of the united states government", r"is a work of the united states government and (?:\w+ ){0,4}not subject to copyright", 8, 0.9),
    ("proprietary", "all rights reserved no part", r"all rights reserved no part of this", 6, 0.75),
    ("proprietary", "non transferable license to use", r"(?:grants? you )?a (?:limited |personal |revocable ){0,3}non exclusive non transferable license to use", 6, 0.8),
    ("proprietary", "evaluation purposes only", r"for (?:internal )?evaluation purposes only", 5, 0.7),
    ("proprietary", "u s government restricted rights", r"u s government restricted rights", 6, 0.8),
    ("shareware", "this is not free software", r"(?:shareware|this is not free software) (?:\w+ ){0,6}(?:register|registration)", 5, 0.7),
    ("noncommercial", "educational purposes only", r"for (?:personal |academic |private )?educational purposes only", 5, 0.7),
    ("noncommercial", "personal use only", r"(?:licensed )?for personal use only", 4, 0.6),
)
#: Words around a name -> (pattern with the name as %s, priority, relevance).
FORMS = (
    (r"(?:licensed|released|distributed|available|provided|published|covered) (?:\w+ ){0,3}under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?%s", 7, 1.0),
    (r"(?:(?:subject to|according to|in accordance with|governed by) (?:the )?(?:terms (?:and conditions )?of )?|(?:license|licence) (?:is )?|(?:see|under|using|with|via) )?(?:the )?%s", 4, 0.8),
)


class Rule:
    """One signature: its label, family, pattern over the normalised text, keyword, priority and relevance."""

    def __init__(self, family: str, label: str, pattern: str, keyword: str, priority: int, relevance: float):
        self.family, self.label, self.keyword, self.priority, self.relevance = family, label, keyword, priority, relevance
        self.pattern = re.compile(rf"(?<= ){pattern}(?= )")


@lru_cache(1)
def rules() -> tuple[list[Rule], ahocorasick.Automaton]:
    """All rules, made from the families and forms, and the automaton of their keywords."""
    made: list[Rule] = []
    for family, (names, ids, versions) in FAMILIES.items():
        for name in names:
            for form, priority, relevance in FORMS:
                made.append(Rule(family, family, form % re.escape(name), name, priority, relevance))
            for v in versions:
                made.append(Rule(family, f"{family} {v}", rf"(?:the )?{re.escape(name)} (?:version |v )?v?{v}(?: or (?:any )?later)?", name, 8, 1.0))
        for x in ids:
            for v in (*versions, ""):
                tail = rf" ?v?{v}(?: only| or later)?" if v else ""
                made.append(Rule(family, f"{family} {v}".strip(), rf"spdx license identifier {re.escape(x)}{tail}", "spdx license identifier", 10 + bool(v), 1.0))
    for label, keyword, pattern, priority, relevance in SIGNATURES:
        family = next((f for f in sorted(FAMILIES, key=len, reverse=True) if label == f or label.startswith(f"{f} ")), label)
        made.append(Rule(family, label, pattern, keyword, priority, relevance))
    keys = ahocorasick.Automaton()
    for k in {r.keyword for r in made} | set(BASE):
        keys.add_word(f" {k} ", k)
    keys.make_automaton()
    return made, keys


def detect(text: str, found: set[str]) -> list[tuple[int, int, Rule]]:
    """Detections (start, end, rule) in a normalised text that hold after suppression."""
    hits = [(m.start(), m.end(), r) for r in rules()[0] if r.keyword in found for m in r.pattern.finditer(text)]
    held: list[tuple[int, int, Rule]] = []
    # Detections of one family never overlap: at most one of each can hold a later one, found by its start.
    taken: dict[str, tuple[list[int], list[int]]] = {}
    for a, b, r in sorted(hits, key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].label)):
        if any((k := bisect_right(starts, a)) and b <= ends[k - 1] for starts, ends in taken.values()):
            continue
        starts, ends = taken.setdefault(r.family, ([], []))
        k = bisect_right(starts, a)
        if (k and ends[k - 1] > a) or (k < len(starts) and starts[k] < b):
            continue
        starts.insert(k, a)
        ends.insert(k, b)
        held.append((a, b, r))
    return sorted(held, key=lambda h: h[:2])


def row(doc_id, data: bytes) -> tuple:
    words = data.translate(ALNUM).split()
    text = " " + b" ".join(words).decode("utf-8", "replace") + " "
    places = [(end - len(k) - 1, k) for end, k in rules()[1].iter(text)] if words else []
    base = [(at, k) for at, k in places if k in BASE]
    starts, last, n = [], 0, 0
    for at, _ in sorted(base):
        n += text.count(" ", last, at)
        last = at
        starts.append(n)
    held = detect(text, {k for _, k in places}) if places else []
    labels = {BASE[k] for _, k in base}
    score = max([r.relevance for _, _, r in held] + [0.7] * bool(base), default=0.0)
    return (doc_id, len(words), len(base), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(labels)),
            ",".join(sorted(labels | {r.label for _, _, r in held})), score)


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: word and base counts, labels and the relevance of the best detection."""
    return map_rows(
        id_text(df, id_col, text_col),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
        row,
    )
