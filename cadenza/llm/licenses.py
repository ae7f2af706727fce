"""License scans: ordered signature rules over a text's words, in DataFrame functions only.

A text becomes its words between single blanks. Keywords found in it choose the rules to try (an equi-join, so a rule is
tried only where its keyword occurs); a rule's matches become word intervals. Where intervals contain one another, the
outer one stands, of equal ones the rule that comes first; where they merely overlap, the rule of higher priority stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import ascii_lower, read

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Contract phrases and their labels; always counted and never suppressed.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Names of licenses, how they may be written, over words: label, keyword that every form holds, pattern. After a name a
#: version may follow, and before it a phrase that grants.
NAMES = [
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("gpl", "gplv2", "gplv2"),
    ("gpl", "gplv3", "gplv3"),
    ("gpl", "gnu", "gnu (?:general )?public licen[cs]e"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl", "library", "(?:gnu )?library general public licen[cs]e"),
    ("agpl", "agpl", "(?:gnu )?agpl"),
    ("agpl", "affero", "(?:gnu )?affero (?:general )?public licen[cs]e"),
    ("gfdl", "gfdl", "(?:gnu )?gfdl"),
    ("gfdl", "documentation", "(?:gnu )?free documentation licen[cs]e"),
    ("apache", "apache", "apache (?:software )?licen[cs]e"),
    ("apache", "asl", "asl"),
    ("mit", "mit", "mit licen[cs]e"),
    ("mit", "expat", "expat licen[cs]e"),
    ("x11", "x11", "(?:mit )?x11 licen[cs]e"),
    ("bsd", "bsd", "(?:new |revised |modified |simplified |original )?bsd(?: style)? licen[cs]e"),
    ("bsd", "clause", "(?:bsd [0234] clause|(?:[0234]|two|three|four) clause bsd)(?: licen[cs]e)?"),
    ("isc", "isc", "isc licen[cs]e"),
    ("mpl", "mpl", "mpl"),
    ("mpl", "mozilla", "mozilla public licen[cs]e"),
    ("epl", "eclipse", "eclipse public licen[cs]e"),
    ("edl", "eclipse", "eclipse distribution licen[cs]e"),
    ("eupl", "eupl", "eupl"),
    ("eupl", "european", "european union public licen[cs]e"),
    ("cddl", "cddl", "cddl"),
    ("cddl", "development", "common development and distribution licen[cs]e"),
    ("cpl", "common", "common public licen[cs]e"),
    ("cpal", "attribution", "common public attribution licen[cs]e"),
    ("ipl", "ibm", "ibm public licen[cs]e"),
    ("artistic", "artistic", "(?:perl |clarified )?artistic licen[cs]e"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e"),
    ("libpng", "libpng", "libpng licen[cs]e"),
    ("boost", "boost", "boost software licen[cs]e"),
    ("unlicense", "unlicense", "the unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("beerware", "beerware", "beerware licen[cs]e"),
    ("cc0", "cc0", "cc0"),
    ("cc0", "zero", "(?:creative commons|cc) zero"),
    ("cc-by", "cc", "cc by(?! (?:sa|nc|nd))"),
    ("cc-by", "creative", "creative commons attribution(?! (?:share|non|no))(?: licen[cs]e)?"),
    ("cc-by-sa", "sa", "cc by sa"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike(?: licen[cs]e)?"),
    ("cc-by-nc", "nc", "cc by nc(?! (?:sa|nd))"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial(?! (?:share|no))(?: licen[cs]e)?"),
    ("cc-by-nd", "nd", "cc by nd"),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s(?: licen[cs]e)?"),
    ("cc-by-nc-sa", "nc", "cc by nc sa"),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike(?: licen[cs]e)?"),
    ("cc-by-nc-nd", "nc", "cc by nc nd"),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: licen[cs]e)?"),
    ("ofl", "font", "(?:sil )?open font licen[cs]e"),
    ("odbl", "odbl", "odbl"),
    ("odbl", "database", "open (?:data commons )?open ?database licen[cs]e|open database licen[cs]e"),
    ("odc-by", "commons", "open data commons attribution licen[cs]e"),
    ("pddl", "pddl", "pddl"),
    ("python", "python", "python (?:software foundation )?licen[cs]e"),
    ("php", "php", "php licen[cs]e"),
    ("ruby", "ruby", "ruby licen[cs]e"),
    ("openssl", "openssl", "openssl licen[cs]e"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e"),
    ("ms-rl", "reciprocal", "microsoft reciprocal licen[cs]e"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    ("afl", "academic", "academic free licen[cs]e"),
    ("osl", "osl", "osl"),
    ("osl", "software", "open software licen[cs]e"),
    ("qpl", "qpl", "qpl"),
    ("qpl", "public", "q public licen[cs]e"),
    ("apsl", "apple", "apple public source licen[cs]e"),
    ("sspl", "sspl", "sspl"),
    ("sspl", "server", "server side public licen[cs]e"),
    ("busl", "business", "business source licen[cs]e"),
    ("elastic", "elastic", "elastic licen[cs]e"),
    ("lppl", "latex", "latex project public licen[cs]e"),
    ("cecill", "cecill", "cecill(?: [bc])?(?: licen[cs]e)?"),
    ("rpl", "reciprocal", "reciprocal public licen[cs]e"),
    ("sleepycat", "sleepycat", "sleepycat licen[cs]e"),
    ("vim", "vim", "vim licen[cs]e"),
    ("w3c", "w3c", "w3c (?:software notice and |software )?licen[cs]e"),
    ("upl", "universal", "universal permissive licen[cs]e"),
    ("blueoak", "oak", "blue oak model licen[cs]e"),
    ("json", "json", "json licen[cs]e"),
    ("ftl", "freetype", "freetype (?:project )?licen[cs]e"),
    ("openrail", "openrail", "(?:bigscience |creativeml )?openrail(?: m)?(?: licen[cs]e)?"),
    ("llama", "llama", "llama (?:2 |3 |3 1 |3 2 )?community licen[cs]e(?: agreement)?"),
    ("gemma", "gemma", "gemma terms of use"),
]
GRANTS = (
    "(?:(?:is |are |be )?(?:dual )?(?:licen[cs]ed|released|distributed|published|available|provided|redistributed|covered)"
    "(?: to you)? (?:under|by|subject to)|under|subject to|according to|governed by|in accordance with) "
    "(?:the )?(?:terms (?:and conditions )?of (?:the )?)?"
)
#: How a version follows a name, and what may follow that.
VERSION = "(?:,? ?(?:version |ver |v )?v?[0-9](?: [0-9])?(?: only| or (?:any )?later(?: version)?)?)?"

#: Passages of license texts and notices that tell by themselves: label, priority, score, rarest word, pattern over words.
PASSAGES = [
    ("mit", 1, 1.0, "granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 1, 0.9, "noninfringement", "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable"),
    ("mit", 1, 0.95, "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", 2, 0.8, "substantial", "this permission notice shall be included in all copies or substantial portions"),
    ("mit-0", 1, 0.9, "attribution", "mit no attribution"),
    ("x11", 1, 0.9, "consortium", "name of the x consortium shall not be used in advertising"),
    ("isc", 1, 1.0, "fee", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", 1, 0.8, "disclaims", "the software is provided as is and (?:the author|isc) disclaims all warranties"),
    ("0bsd", 1, 0.9, "0bsd", "0bsd"),
    ("0bsd", 1, 0.9, "zero", "zero clause bsd"),
    ("bsd", 1, 1.0, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 2, 0.8, "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", 2, 0.8, "reproduce", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", 1, 0.9, "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd", 1, 0.95, "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("bsd", 2, 0.8, "contributors", "this software is provided by the (?:copyright holders and contributors|regents and contributors|author) as is"),
    ("bsd", 2, 0.8, "consequential", "direct indirect incidental special exemplary or consequential damages"),
    ("bsd", 1, 0.9, "regents", "the regents of the university of california"),
    ("apache", 1, 1.0, "compliance", "you may not use this file except in compliance with the licen[cs]e"),
    ("apache", 1, 0.9, "conditions", "distributed on an as is basis without warranties or conditions of any kind"),
    ("apache", 1, 1.0, "asf", "licen[cs]ed to the apache software foundation asf under one or more contributor licen[cs]e agreements"),
    ("apache", 1, 0.9, "reproduction", "terms and conditions for use reproduction and distribution"),
    ("apache", 1, 0.9, "irrevocable", "perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated)"),
    ("apache", 1, 1.0, "licenses", "www apache org licenses license 2 0"),
    ("apache", 1, 0.95, "apache", "this product includes software developed by the apache software foundation"),
    ("gpl", 1, 1.0, "redistribute", "this program is free software you can redistribute it and or modify it"),
    ("gpl", 1, 0.9, "hope", "distributed in the hope that it will be useful but without any warranty"),
    ("gpl", 1, 0.9, "option", "either version [23] of the licen[cs]e or at your option any later version"),
    ("gpl", 1, 0.95, "franklin", "free software foundation inc 5[19] (?:franklin street|temple place)"),
    ("gpl", 1, 0.95, "freedom", "the licen[cs]es for most software are designed to take away your freedom"),
    ("gpl", 1, 0.95, "copyleft", "is a free copyleft licen[cs]e for software and other kinds of works"),
    ("gpl", 1, 0.9, "received", "you should have received a copy of the gnu general public licen[cs]e"),
    ("gpl", 1, 0.9, "convey", "you may convey verbatim copies of the program s source code"),
    ("gpl", 1, 0.9, "exception", "gpl (?:linking |classpath |font )?exception|as a special exception the copyright holders"),
    ("gpl", 2, 0.8, "verbatim", "everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document"),
    ("gpl", 1, 0.9, "www", "www gnu org licenses(?: gpl)?"),
    ("lgpl", 1, 1.0, "library", "this library is free software you can redistribute it and or modify it"),
    ("lgpl", 1, 0.9, "lesser", "you should have received a copy of the gnu lesser general public licen[cs]e"),
    ("lgpl", 1, 0.9, "library", "work that uses the library"),
    ("lgpl", 1, 0.9, "linking", "combined work is a work produced by combining or linking"),
    ("agpl", 1, 0.95, "affero", "you should have received a copy of the gnu affero general public licen[cs]e"),
    ("agpl", 1, 0.9, "remotely", "users interacting with it remotely through a computer network"),
    ("gfdl", 1, 1.0, "invariant", "with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", 1, 0.95, "document", "permission is granted to copy distribute and or modify this document under the terms of"),
    ("mpl", 1, 1.0, "mozilla", "this source code form is subject to the terms of the mozilla public licen[cs]e"),
    ("mpl", 1, 0.95, "covered", "source code form of the covered software"),
    ("mpl", 1, 0.95, "obtain", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", 1, 0.9, "incompatible", "incompatible with secondary licen[cs]es"),
    ("epl", 1, 1.0, "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse"),
    ("epl", 1, 0.95, "recipient", "any use reproduction or distribution of the program constitutes recipient s acceptance"),
    ("edl", 1, 0.9, "eclipse", "eclipse foundation inc all rights reserved redistribution"),
    ("eupl", 1, 0.95, "licensor", "the licensor hereby grants you a worldwide royalty free non exclusive"),
    ("cddl", 1, 1.0, "header", "do not alter or remove copyright notices or this (?:file )?header"),
    ("cddl", 1, 0.95, "usr", "usr src opensolaris licen[cs]e"),
    ("cddl", 1, 0.95, "initial", "initial developer of the original code"),
    ("cpl", 1, 0.9, "cpl", "the cpl|cpl version 1 0"),
    ("artistic", 1, 1.0, "package", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", 1, 0.95, "artistic", "artistic licen[cs]e which comes with this kit"),
    ("artistic", 1, 0.9, "perl", "same terms as perl(?: 5)? itself"),
    ("zlib", 1, 1.0, "misrepresented", "the origin of this software must not be misrepresented"),
    ("zlib", 1, 0.95, "altered", "altered source versions must be plainly marked as such"),
    ("zlib", 1, 0.95, "implied", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("libpng", 1, 0.95, "png", "png reference library is supplied as is"),
    ("ijg", 1, 1.0, "jpeg", "this software is based in part on the work of the independent jpeg group"),
    ("boost", 1, 1.0, "accompanying", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying|see accompanying file licen[cs]e 1 0 txt"),
    ("unlicense", 1, 1.0, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", 1, 0.95, "successors", "for the benefit of the public at large and to the detriment of our heirs and successors"),
    ("unlicense", 1, 0.9, "unlicense", "unlicense org"),
    ("wtfpl", 1, 1.0, "fuck", "do what the fuck you want to(?: public licen[cs]e)?"),
    ("beerware", 1, 1.0, "beer", "you can buy me a beer in return|the beer ware licen[cs]e"),
    ("cc0", 1, 1.0, "waived", "has waived all copyright and related or neighboring rights"),
    ("cc0", 1, 0.95, "cc0", "cc0 1 0 universal|creative commons cc0"),
    ("cc0", 1, 0.95, "publicdomain", "creativecommons org publicdomain zero"),
    ("public-domain", 1, 0.95, "mark", "public domain mark(?: 1 0)?"),
    ("public-domain", 2, 0.9, "domain", "(?:released into|placed in|placed into|in|dedicated to|donated to) the public domain"),
    ("public-domain", 2, 0.85, "government", "(?:is a )?work of the united states government"),
    ("public-domain", 2, 0.85, "protection", "not subject to copyright protection"),
    ("cc-by", 1, 1.0, "creativecommons", "creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", 1, 1.0, "creativecommons", "creativecommons org licenses by sa"),
    ("cc-by-nc", 1, 1.0, "creativecommons", "creativecommons org licenses by nc(?! (?:sa|nd))"),
    ("cc-by-nd", 1, 1.0, "creativecommons", "creativecommons org licenses by nd"),
    ("cc-by-nc-sa", 1, 1.0, "creativecommons", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", 1, 1.0, "creativecommons", "creativecommons org licenses by nc nd"),
    ("cc-by", 1, 0.9, "credit", "you must give appropriate credit provide a link to the licen[cs]e"),
    ("cc-by-sa", 1, 0.9, "remix", "if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e"),
    ("cc-by-sa", 2, 0.85, "text", "text is available under the creative commons attribution share ?alike"),
    ("cc-by-nc", 1, 0.9, "commercial", "you may not use the material for commercial purposes"),
    ("cc-by-nd", 1, 0.9, "modified", "you may not distribute the modified material"),
    ("cc", 3, 0.6, "creative", "creative commons(?: licen[cs]e)?"),
    ("cc", 3, 0.6, "reserved", "some rights reserved"),
    ("ofl", 1, 1.0, "font", "this font software is licen[cs]ed under the sil"),
    ("ofl", 1, 0.95, "reserved", "with reserved font names?"),
    ("ofl", 1, 0.9, "scripts", "scripts sil org ofl"),
    ("odbl", 1, 0.95, "opendatacommons", "opendatacommons org licenses odbl"),
    ("odbl", 1, 0.95, "openstreetmap", "openstreetmap contributors"),
    ("odc-by", 1, 0.95, "opendatacommons", "opendatacommons org licenses by"),
    ("pddl", 1, 0.95, "opendatacommons", "opendatacommons org licenses pddl"),
    ("python", 1, 1.0, "psf", "psf licen[cs]e agreement|psf is making python available to licensee"),
    ("python", 1, 0.95, "cnri", "cnri open source licen[cs]e agreement|cnri licen[cs]e agreement"),
    ("php", 1, 1.0, "php", "this (?:source file is subject to version 3 0[01]? of the php licen[cs]e|product includes php software)"),
    ("openssl", 1, 1.0, "openssl", "this product includes software developed by the openssl project"),
    ("openssl", 1, 0.95, "eric", "cryptographic software written by eric young"),
    ("postgresql", 1, 1.0, "postgresql", "postgresql (?:database management system|global development group)"),
    ("ncsa", 1, 0.95, "illinois", "university of illinois at urbana champaign"),
    ("curl", 1, 0.9, "stenberg", "daniel stenberg"),
    ("ms-pl", 1, 0.95, "contribution", "each contributor grants you a non exclusive worldwide royalty free copyright licen[cs]e to reproduce its contribution"),
    ("ms-eula", 1, 0.9, "microsoft", "microsoft software licen[cs]e terms"),
    ("apsl", 1, 0.95, "apsl", "apsl"),
    ("afl", 1, 0.9, "afl", "afl 3 0"),
    ("osl", 1, 0.9, "osl", "osl 3 0"),
    ("sspl", 1, 0.95, "sspl", "sspl v1"),
    ("busl", 1, 0.95, "grant", "additional use grant"),
    ("elastic", 1, 0.95, "elastic", "elastic licen[cs]e 2 0|licen[cs]ed under the elastic licen[cs]e"),
    ("commons-clause", 1, 0.95, "clause", "commons clause(?: licen[cs]e condition)?"),
    ("polyform", 1, 0.95, "polyform", "polyform (?:noncommercial|small business|shield|strict|perimeter)(?: licen[cs]e)?"),
    ("lppl", 1, 0.95, "lppl", "lppl"),
    ("cecill", 1, 0.95, "cea", "by cea cnrs and inria"),
    ("nasa", 1, 0.9, "nasa", "nasa open source agreement"),
    ("w3c", 1, 0.95, "w3c", "w3c document licen[cs]e|w3c software notice"),
    ("unicode", 1, 0.95, "unicode", "unicode (?:data files and software|inc licen[cs]e agreement|licen[cs]e v3)"),
    ("icu", 1, 0.9, "icu", "icu licen[cs]e"),
    ("oracle-bcl", 1, 0.95, "oracle", "oracle binary code licen[cs]e agreement"),
    ("oracle-tech", 1, 0.95, "oracle", "oracle technology network licen[cs]e"),
    ("sun-bcl", 1, 0.95, "sun", "sun microsystems inc binary code licen[cs]e agreement"),
    ("nvidia-eula", 1, 0.95, "nvidia", "nvidia (?:software )?licen[cs]e agreement|nvidia cuda toolkit"),
    ("intel-simplified", 1, 0.9, "intel", "intel simplified software licen[cs]e"),
    ("apple-eula", 1, 0.9, "application", "licensed application end user licen[cs]e agreement"),
    ("gutenberg", 1, 1.0, "gutenberg", "project gutenberg(?: tm)? licen[cs]e"),
    ("gutenberg", 1, 0.9, "anywhere", "this e ?book is for the use of anyone anywhere"),
    ("gutenberg", 2, 0.8, "gutenberg", "project gutenberg"),
    ("ogl", 1, 0.95, "government", "open government licen[cs]e(?: v[123])?"),
    ("crown", 1, 0.9, "crown", "crown copyright"),
    ("etalab", 1, 0.95, "etalab", "etalab"),
    ("etalab", 1, 0.95, "ouverte", "licence ouverte"),
    ("dl-de", 1, 0.95, "datenlizenz", "datenlizenz deutschland"),
    ("openrail", 1, 0.95, "rail", "rail(?: m)? licen[cs]e"),
    ("openrail", 1, 0.9, "restrictions", "use based restrictions (?:as referenced|set forth)"),
    ("eula", 2, 0.8, "eula", "eula"),
    ("eula", 2, 0.85, "end", "end user licen[cs]e agreement"),
    ("proprietary", 1, 0.9, "confidential", "(?:proprietary and confidential|confidential and proprietary|company confidential)"),
    ("proprietary", 1, 0.9, "unauthorized", "unauthorized (?:copying|reproduction|use|distribution)(?: or distribution)? of this (?:file|software|document|work)"),
    ("proprietary", 1, 0.9, "consent", "without (?:the )?(?:prior |express )*written (?:consent|permission) of"),
    ("proprietary", 2, 0.85, "reproduced", "(?:may not|no part of this (?:publication|book|work) may) be reproduced"),
    ("proprietary", 2, 0.8, "reverse", "reverse engineer decompile or disassemble"),
    ("proprietary", 2, 0.7, "rights", "all rights reserved"),
    ("proprietary", 2, 0.7, "vorbehalten", "alle rechte vorbehalten"),
    ("proprietary", 2, 0.7, "reservados", "todos los derechos reservados"),
    ("proprietary", 2, 0.7, "réservés", "tous droits réservés"),
    ("proprietary", 2, 0.7, "secrets", "trade secrets"),
    ("non-commercial", 2, 0.8, "noncommercial", "(?:for )?noncommercial (?:use|purposes)(?: only)?"),
    ("non-commercial", 2, 0.8, "commercial", "not for commercial (?:use|purposes)|for non commercial (?:use|purposes)(?: only)?"),
    ("non-commercial", 2, 0.8, "personal", "for personal (?:and non commercial )?use only"),
    ("non-commercial", 2, 0.8, "academic", "for (?:academic|research|educational)(?: and research)? (?:use|purposes) only"),
    ("evaluation", 2, 0.8, "evaluation", "for evaluation (?:use|purposes) only"),
    ("shareware", 2, 0.8, "shareware", "this (?:program|software) is shareware"),
    ("freeware", 2, 0.7, "freeware", "this (?:program|software) is freeware"),
    ("permissive", 2, 0.6, "permitted", "copying and distribution of this file with or without modification are permitted"),
    ("permissive", 3, 0.5, "freely", "(?:may be )?freely (?:distributed|distributable|copied|redistributed|used)"),
    ("permissive", 3, 0.5, "royalty", "royalty free(?: licen[cs]e)?"),
    ("copyleft", 3, 0.5, "copyleft", "copyleft"),
    ("open-source", 3, 0.5, "open", "open source licen[cs]e"),
    ("dual-license", 2, 0.7, "dual", "dual licen[cs]ed"),
    ("warranty-disclaimer", 3, 0.4, "warranty", "without warrant(?:y|ies) of any kind"),
    ("warranty-disclaimer", 3, 0.4, "merchantability", "implied warrant(?:y|ies) of merchantability"),
    ("warranty-disclaimer", 3, 0.4, "liability", "limitation of liability"),
    ("trademark", 3, 0.4, "trademarks", "are (?:registered )?trademarks (?:or registered trademarks )?of"),
    ("patent", 3, 0.4, "patent", "patent (?:licen[cs]e|grant)"),
    ("dmca", 3, 0.5, "dmca", "dmca(?: notice)?"),
    ("terms", 3, 0.4, "terms", "terms of (?:use|service)"),
    ("copyright", 3, 0.3, "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("some-license", 4, 0.4, "licensed", "licensed under"),
    ("some-license", 4, 0.4, "licenced", "licenced under"),
    ("some-license", 4, 0.3, "license", "(?:this|the) license"),
    ("some-license", 4, 0.3, "licence", "(?:this|the) licence"),
    ("some-license", 4, 0.3, "lizenz", "unter der lizenz"),
    ("some-license", 4, 0.3, "licencia", "bajo (?:la )?licencia"),
    ("some-license", 4, 0.3, "licence", "sous (?:la )?licence"),
]


def rules() -> list[tuple[int, int, str, float, str, str, bool]]:
    """(order, priority, label, score, keyword, pattern, base), base rules first, then by priority and length of pattern.

    A name gives three: behind the tag of a license identifier, behind a phrase that grants, and by itself.
    """
    found = [(0, label, 1.0, phrase.split()[0], phrase, True) for phrase, label in BASE.items()]
    for label, keyword, name in NAMES:
        whole = f"(?:{name}){VERSION}"
        found.append((1, label, 1.0, keyword, f"spdx licen[cs]e identifier {whole}", False))
        found.append((2, label, 1.0, keyword, GRANTS + whole, False))
        found.append((3, label, 0.8, keyword, whole, False))
    found += [(p, label, score, keyword, pattern, False) for label, p, score, keyword, pattern in PASSAGES]
    ordered = sorted(found, key=lambda r: (r[0], not r[5], -len(r[4]), r[1], r[4]))
    return [(i, *r) for i, r in enumerate(ordered)]


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        rules(), "order int, priority int, label string, score double, keyword string, pattern string, base boolean"
    )


def _matches(text: str, pattern: str) -> Column:
    """Array of (first, last) word positions of a pattern's matches in ' word word ': their ends are marked, then counted."""
    whole = F.concat(F.lit("(?<= )(?:"), F.col(pattern), F.lit(")(?= )"))
    words = F.split(F.trim(F.regexp_replace(F.col(text), whole, F.lit("\x01$0\x02"))), " ")
    firsts = F.array_compact(F.transform(words, lambda w, i: F.when(F.startswith(w, F.lit("\x01")), i)))
    lasts = F.array_compact(F.transform(words, lambda w, i: F.when(F.endswith(w, F.lit("\x02")), i)))
    pairs = F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    return F.when(F.regexp_like(F.col(text), whole), pairs)


def detections(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row for each match, and one without a match for each row of docs that has none.

    row identifies the row of docs; doc_id, n_words, order, priority, label, score, base, first, last (word positions
    from 0) and stands, which tells whether no other match suppresses it. The rules are broadcast; their number is fixed.
    """
    keywords = sorted({r[4] for r in rules()})
    words = (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).alias("doc_id"),
            F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0)).alias("words"),
        )
        .withColumn("n_words", F.size("words").cast("bigint"))
        .withColumn("has", F.array_intersect("words", F.array(*map(F.lit, keywords))))
        .withColumn("words", F.when(F.size("has") > 0, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))))
    )
    tried = words.withColumn("keyword", F.explode_outer("has")).drop("has")
    found = (
        tried.join(F.broadcast(rules_table(docs.sparkSession)), "keyword", "left")
        .withColumn("hits", _matches("words", "pattern"))
        .drop("words", "keyword", "pattern")
    )
    each = (
        found.groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.collect_list(
                F.when(F.size("hits") > 0, F.struct("order", "priority", "label", "score", "base", "hits"))
            ).alias("all")
        )
        .withColumn("rule", F.explode_outer("all"))
        .withColumn("hit", F.explode_outer("rule.hits"))
        .select("row", "doc_id", "n_words", "rule.order", "rule.priority", "rule.label", "rule.score", "rule.base", "hit.*")
    )
    near = Window.partitionBy("row").orderBy(F.col("first"), F.col("last").desc(), "order")
    before = near.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.max("last").over(before) >= F.col("last"), F.lit(False))
    outer = each.withColumn("inside", inside)
    crossed = F.lit(False)
    later = Window.partitionBy("row").orderBy(F.col("first").desc(), F.col("last"), F.col("order").desc())
    for p in range(4):  # of overlapping intervals, those of higher priority stand
        strong = (F.col("priority") <= p) & ~F.col("inside")
        reach = F.max(F.when(strong, F.col("last"))).over(before) >= F.col("first")
        comes = F.min(F.when(strong, F.col("first"))).over(later.rowsBetween(Window.unboundedPreceding, -1)) <= F.col("last")
        crossed = crossed | ((F.col("priority") > p) & (F.coalesce(reach, F.lit(False)) | F.coalesce(comes, F.lit(False))))
    return outer.withColumn("stands", ~F.col("inside") & ~crossed).drop("inside")


def license_labels(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of docs.

    n_base counts all places of base phrases, first_word and last_word are their smallest and largest start (null without
    any). labels are those of base phrases and of matches that stand; score is the greatest of their rules, 0 without
    any. Null and empty texts have no words and no labels. Repeated rows are judged each. An empty table gives none.
    Other columns are ignored.
    """
    base, stands = F.coalesce("base", F.lit(False)), F.coalesce("stands", F.lit(False))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        detections(docs, text, doc_id)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.count_if(base).cast("bigint").alias("n_base"),
            F.min(F.when(base, F.col("first"))).cast("bigint").alias("first_word"),
            F.max(F.when(base, F.col("first"))).cast("bigint").alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined(F.when(base | (stands & F.col("label").isNotNull()), F.col("label"))).alias("labels"),
            F.coalesce(F.max(F.when(base | stands, F.col("score"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )


def op4_licenses(spark, sf_dir: str) -> DataFrame:
    return license_labels(read(spark, sf_dir, "documents"))


#: Base columns only: the rest is the method's.
OP4_BASE_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p(phrase, label) AS (VALUES (['gnu','general','public','license'], 'gpl'), (['apache','license'], 'apache'),
                            (['cc','by'], 'cc-by'), (['mit','license'], 'mit')),
s AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM t),
h AS (SELECT doc_id, i, label FROM s JOIN p ON w[i + 1 : i + len(phrase)] = phrase)
SELECT t.doc_id, len(w) AS n_words, count(label) AS n_base, min(i) AS first_word, max(i) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM t LEFT JOIN h USING (doc_id) GROUP BY t.doc_id, w
"""
