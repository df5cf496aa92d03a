"""Signature rules of the license scan: texts of licenses, notices, file headers and links.

Each rule is written over normalised words (lower case, joined by single spaces): label, keyword that
every match holds, pattern. Keywords are rare words, so that few texts run a rule. Patterns hold
words, alternatives and bounded gaps only, so a match takes time in proportion to its length.
"""

from __future__ import annotations

#: Openings, clauses and disclaimers of the license texts themselves.
BODIES = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation(?: files)?"),
    ("mit", "sublicense", "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-0", "sublicense", "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("x11", "consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("ncsa", "restriction", "to deal with the software without restriction including without limitation the rights to use copy modify merge publish"),
    ("ncsa", "ncsa", "university of illinois ncsa open source license"),
    ("isc", "hereby", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", "hereby", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("curl", "hereby", "with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is (?:[^ ]+ ){20,90}except as contained in this notice the name of a copyright holder"),
    ("postgresql", "hereby", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "hereby", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose(?: and)? without fee is hereby granted provided that the above copyright notice appears? in all copies"),
    ("hpnd", "hereby", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose is hereby granted without fee provided that the above copyright notice appears? in all copies"),
    ("bsl-1", "hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unicode-dfs", "unicode", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions", "redistributions of source code must retain the(?: above)? copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the(?: above)? copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "warranties", "this software is provided by the (?:copyright holders? and contributors|authors?(?: and contributors)?|regents and contributors) as is and any express or implied warranties"),
    ("bsd-3", "endorse", "neither the names? of (?:[^ ]+ ){1,12}nor the names of (?:its|their|any|other) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-3", "endorse", "the names? of (?:the )?(?:authors?|copyright holders?) may not be used to endorse or promote products derived from this software"),
    ("bsd-3-clear", "patent", "no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-4", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-1.1", "apache", "this product includes software developed by the apache software foundation"),
    ("apache-1.1", "apache", "the names (?:[^ ]+ ){0,4}apache(?: server| software foundation)? must not be used to endorse or promote products"),
    ("apache-2", "apache", "apache license version 2 0 january 2004"),
    ("apache-2", "reproduction", "terms and conditions for use reproduction and distribution 1 definitions license shall mean the terms and conditions"),
    ("apache-2", "irrevocable", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright license|except as stated in this section patent license)"),
    ("gpl-1", "gnu", "gnu general public license version 1 february 1989"),
    ("gpl-2", "gnu", "gnu general public license version 2 june 1991"),
    ("gpl-2", "freedom", "the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license"),
    ("gpl-3", "gnu", "gnu general public license version 3 29 june 2007"),
    ("gpl-3", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl-2", "library", "gnu library general public license version 2 june 1991"),
    ("lgpl-2.1", "lesser", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-2.1", "successor", "this is the first released version of the lesser gpl it also counts as the successor of the gnu library public license"),
    ("lgpl-3", "lesser", "gnu lesser general public license version 3 29 june 2007"),
    ("lgpl-3", "incorporates", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("agpl-3", "affero", "gnu affero general public license version 3 19 november 2007"),
    ("agpl-3", "affero", "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community"),
    ("gcc-exception-3.1", "gcc", "gcc runtime library exception(?: version 3 1)?"),
    ("classpath-exception-2", "executable", "give you permission to link this library with independent modules to produce an executable"),
    ("mpl-2", "mozilla", "mozilla public license version 2 0 1 definitions"),
    ("mpl-2", "secondary", "incompatible with secondary licenses means"),
    ("mpl-1.1", "mozilla", "mozilla public license version 1 1 1 definitions"),
    ("epl", "eclipse", "the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("cpl-1", "accompanying", "the accompanying program is provided under the terms of this common public license agreement"),
    ("ipl-1", "ibm", "the accompanying program is provided under the terms of this ibm public license agreement"),
    ("cddl-1", "distribution", "common development and distribution license(?: cddl)? version 1 0"),
    ("cddl-1.1", "distribution", "common development and distribution license(?: cddl)? version 1 1"),
    ("eupl-1.2", "eupl", "this european union public licence the eupl applies to the work"),
    ("ofl-1.1", "ofl", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("zlib", "liable", "this software is provided as is without any express or implied warranty in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "misrepresented", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "compile", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    ("wtfpl", "verbatim", "permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("cc0", "waived", "to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related or neighboring rights"),
    ("cc0", "deed", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights"),
    ("cc-by", "accept", "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution 4 0 international public license"),
    ("cc-by-sa", "accept", "you accept and agree to be bound by the terms and conditions of this creative commons attribution sharealike 4 0 international public license"),
    ("cc-by-nc", "accept", "you accept and agree to be bound by the terms and conditions of this creative commons attribution noncommercial 4 0 international public license"),
    ("cc-by-nd", "accept", "you accept and agree to be bound by the terms and conditions of this creative commons attribution noderivatives 4 0 international public license"),
    ("artistic-1", "semblance", "the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    ("artistic-2", "establishes", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("psf-2", "python", "this license agreement is between the python software foundation psf and the individual or organization licensee"),
    ("openssl", "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "eric", "this product includes cryptographic software written by eric young"),
    ("php-3", "php", "this product includes php software freely available from"),
    ("w3c", "w3c", "w3c software(?: and document)? notice and license"),
    ("zpl-2.1", "zope", "zope public license(?: zpl)? version 2 1"),
    ("ms-pl", "governs", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("ms-rl", "reciprocal", "reciprocal grants for any file you distribute that contains code from the software"),
    ("sspl-1", "server", "server side public license version 1 october 16 2018"),
    ("elastic-2", "hosted", "you may not provide the software to third parties as a hosted or managed service"),
    ("busl-1.1", "production", "grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("commons-clause", "commons", "commons clause license condition v(?:ersion )?1 0"),
    ("blessing", "disclaims", "the author disclaims copyright to this source code"),
    ("beerware", "stuff", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("unicode-dfs", "unicode", "unicode inc license agreement data files and software"),
    ("ftl", "freetype", "the freetype project license"),
    ("ijg", "jpeg", "this software is based in part on the work of the independent jpeg group"),
    ("upl-1", "universal", "the universal permissive license upl version 1 0"),
    ("odbl", "database", "the open database license odbl is a license agreement intended to allow users to freely share modify and use this database"),
    ("cdla", "community", "community data license agreement (?:permissive|sharing) version [12] 0"),
    ("llama-2", "llama", "llama 2 community license agreement"),
    ("llama-3", "llama", "llama 3(?: [123])? community license agreement"),
    ("openrail", "rail", "(?:creativeml open rail m|bigscience (?:bloom )?(?:open )?rail(?: m)?)"),
)
#: Sentences that put a work under a license.
NOTICES = (
    ("apache-2", "compliance", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "asf", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2", "basis", "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl-1", "gnu", "gnu general public license as published by the free software foundation either version 1"),
    ("gpl-2", "gnu", "gnu general public license as published by the free software foundation (?:either )?version 2(?: of the license)?(?: or at your option any later version)?"),
    ("gpl-2", "gnu", "gnu general public license (?:version |v)2(?: only)? as published by the free software foundation"),
    ("gpl-3", "gnu", "gnu general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or at your option any later version)?"),
    ("gpl-3", "gnu", "gnu general public license (?:version |v)3(?: only)? as published by the free software foundation"),
    ("gpl", "gnu", "you should have received a copy of the gnu general public license along with"),
    ("lgpl-2", "gnu", "gnu library general public license as published by the free software foundation (?:either )?version 2(?: of the license)?(?: or at your option any later version)?"),
    ("lgpl-2.1", "gnu", "gnu lesser general public license as published by the free software foundation (?:either )?version 2 1(?: of the license)?(?: or at your option any later version)?"),
    ("lgpl-3", "gnu", "gnu lesser general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or at your option any later version)?"),
    ("lgpl", "gnu", "you should have received a copy of the gnu (?:lesser|library) general public license along with"),
    ("agpl-3", "affero", "gnu affero general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or at your option any later version)?"),
    ("agpl", "affero", "you should have received a copy of the gnu affero general public license along with"),
    ("gfdl-1.1", "documentation", "under the terms of the gnu free documentation license version 1 1"),
    ("gfdl-1.2", "documentation", "under the terms of the gnu free documentation license version 1 2"),
    ("gfdl-1.3", "documentation", "under the terms of the gnu free documentation license version 1 3"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0"),
    ("mpl-2", "mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2-no-copyleft-exception", "secondary", "this source code form is incompatible with secondary licenses as defined by the mozilla public license v(?:ersion)? 2 0"),
    ("mpl-1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("npl-1", "netscape", "the contents of this file are subject to the netscape public license version 1 [01]"),
    ("epl-1", "eclipse", "made available under the terms of the eclipse public license (?:v ?|version )?1 0"),
    ("epl-2", "eclipse", "made available under the terms of the eclipse public license (?:v ?|version )?2 0"),
    ("cpl-1", "common", "made available under the terms of the common public license(?: cpl)? (?:v ?|version )?1 0"),
    ("cddl-1", "distribution", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl-1.1", "eupl", "licensed under the eupl(?: version)? (?:v ?)?1 1"),
    ("eupl-1.2", "eupl", "licensed under the eupl(?: version)? (?:v ?)?1 2"),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "font", "with reserved font names?"),
    ("bsl-1", "boost", "distributed under the boost software license version 1 0"),
    ("cc-by", "creative", "licensed under an? creative commons attribution(?: [1-4] [05])? (?:international|unported|generic|license)"),
    ("cc-by-sa", "creative", "licensed under an? creative commons attribution share ?alike"),
    ("cc-by-nc", "creative", "licensed under an? creative commons attribution non ?commercial(?: [1-4] [05])? (?:international|unported|generic|license)"),
    ("cc-by-nd", "creative", "licensed under an? creative commons attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc-sa", "creative", "licensed under an? creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "creative", "licensed under an? creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    ("perl", "perl", "under the same terms as (?:the )?perl(?: 5)?(?: programming language)?(?: system)? itself"),
    ("ruby", "ruby", "under the same terms as ruby(?: itself)?"),
    ("php-3", "php", "this source file is subject to version 3 0 of the php license"),
    ("php-3.01", "php", "this source file is subject to version 3 01 of the php license"),
    ("cecill-2.1", "cecill", "governed by the cecill license under french law"),
    ("cecill-b", "cecill", "governed by the cecill b license under french law"),
    ("cecill-c", "cecill", "governed by the cecill c license under french law"),
    ("ogl-uk-1", "government", "licensed under the open government licence (?:v ?|version )?1 0"),
    ("ogl-uk-2", "government", "licensed under the open government licence (?:v ?|version )?2 0"),
    ("ogl-uk-3", "government", "licensed under the open government licence (?:v ?|version )?3 0"),
    ("odbl", "database", "made available under the open database license"),
    ("dbcl", "database", "licensed under the database contents license"),
    ("afl-3", "academic", "academic free license (?:v ?|version )?3 0"),
    ("osl-3", "software", "licensed under the open software license (?:v ?|version )?3 0"),
    ("ecl-2", "educational", "educational community license (?:v ?|version )?2 0"),
    ("mulan-psl-2", "mulan", "(?:mulan psl v ?2|mulan permissive software license (?:v ?|version )2)"),
    ("busl-1.1", "business", "business source license (?:v ?|version )?1 1"),
    ("sspl-1", "server", "server side public license(?: sspl)? (?:v ?|version )1"),
    ("elastic-2", "elastic", "elastic license (?:v ?|version )?2(?: 0)?"),
    ("public-domain", "domain", "(?:work|software|file|code|text|document) (?:is|has been) (?:hereby )?(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "confidential", "(?:proprietary and confidential|confidential and proprietary) (?:[^ ]+ ){0,12}unauthorized (?:copying|use|distribution|reproduction)"),
)
#: Links to license texts.
LINKS = (
    ("apache-1.1", "apache", "apache org licenses license 1 1"),
    ("apache-2", "apache", "apache org licenses license 2 0"),
    ("gpl-2", "gnu", "gnu org (?:old )?licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3", "gnu", "gnu org licenses gpl 3 0"),
    ("lgpl-2.1", "gnu", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3", "gnu", "gnu org licenses lgpl 3 0"),
    ("agpl-3", "gnu", "gnu org licenses agpl 3 0"),
    ("gfdl-1.3", "gnu", "gnu org licenses fdl 1 3"),
    ("mpl-1.1", "mozilla", "mozilla org mpl (?:mpl )?1 1"),
    ("mpl-2", "mozilla", "mozilla org (?:en us )?mpl 2 0"),
    ("epl-1", "eclipse", "eclipse org (?:org )?(?:legal|documents) epl (?:v ?10|1 0)"),
    ("epl-2", "eclipse", "eclipse org (?:org )?(?:legal|documents) epl (?:v ?20|2 0)"),
    ("bsl-1", "boost", "boost org license 1 0"),
    ("unlicense", "unlicense", "unlicense org"),
    ("ofl-1.1", "sil", "scripts sil org ofl"),
    ("ofl-1.1", "openfontlicense", "openfontlicense org"),
    ("wtfpl", "wtfpl", "wtfpl net"),
    ("json", "json", "json org license"),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons", "creativecommons org publicdomain mark 1 0"),
    ("odbl", "opendatacommons", "opendatacommons org licenses odbl"),
    ("odc-by", "opendatacommons", "opendatacommons org licenses by"),
    ("pddl", "opendatacommons", "opendatacommons org licenses pddl"),
    ("mit", "opensource", "opensource org licenses? mit"),
    ("bsd-2", "opensource", "opensource org licenses? bsd 2 clause"),
    ("bsd-3", "opensource", "opensource org licenses? bsd 3 clause"),
    ("isc", "opensource", "opensource org licenses? isc"),
    ("apache-2", "opensource", "opensource org licenses? apache 2 0"),
    ("gpl-2", "opensource", "opensource org licenses? gpl 2 0"),
    ("gpl-3", "opensource", "opensource org licenses? gpl 3 0"),
    ("lgpl-2.1", "opensource", "opensource org licenses? lgpl 2 1"),
    ("lgpl-3", "opensource", "opensource org licenses? lgpl 3 0"),
    ("agpl-3", "opensource", "opensource org licenses? agpl 3 0"),
    ("mpl-2", "opensource", "opensource org licenses? mpl 2 0"),
    ("epl-2", "opensource", "opensource org licenses? epl 2 0"),
    ("artistic-2", "opensource", "opensource org licenses? artistic(?: license)? 2 0"),
    ("zlib", "opensource", "opensource org licenses? zlib"),
    ("bsl-1", "opensource", "opensource org licenses? bsl 1 0"),
    ("afl-3", "opensource", "opensource org licenses? afl 3 0"),
    ("osl-3", "opensource", "opensource org licenses? osl 3 0"),
)
#: Priority and confidence of each kind. A license's text outweighs a notice, a notice a link.
KINDS = ((8, 1.0, BODIES), (7, 0.95, NOTICES), (6, 0.9, LINKS))
