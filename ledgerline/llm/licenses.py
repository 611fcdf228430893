"""License scan with ordered signature rules.

Signatures are written by hand for the texts of licenses and for the notices
that point to them: sentences that stand in one license only, titles with their
dates, the standard notice of each version, and acronyms after "under".  Beside
them each license has a name pattern, a keyword and an identifier; every form
in which licenses are mentioned (identifier tags and the parts of their
expressions, links, metadata fields, "licensed under ...", titles, bare names)
makes one rule of each license.  These are over three hundred regular
expressions in all.  A signature whose text goes on (a third clause, an
endorsement) has a higher priority than the one it contains, which is then
suppressed.  One pass of an Aho-Corasick automaton over the text finds
the keywords, and only the rules whose keyword occurs are tried.  Detections
are then resolved: taken in order of priority, one that lies within a
detection of equal or higher priority is suppressed.

Beside that, fixed base phrases are looked up in the sequence of the text's
words.  All of a document's work happens in the task that reads it; nothing
is shuffled.

Defined results: a null or empty text has no words, no labels and score 0;
repeated rows get equal results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow

# Identifier, keyword that every mention contains, name as a
# pattern (a space stands for any white space), bare short form or "".
LICENSES = (
    ("0bsd", r"bsd", r"bsd zero[- ]clause", r"0bsd"),
    ("afl-3.0", r"academic", r"academic free", r"afl-3\.0"),
    ("agpl-3.0", r"affero", r"(?:gnu )?affero general public", r"agpl(?:v3|-3\.0)"),
    ("apache-1.1", r"apache", r"apache software", ""),
    ("apache-2.0", r"apache", r"apache", r"apache(?:-| )2\.0"),
    ("artistic-2.0", r"artistic", r"(?:the )?artistic", r"artistic-2\.0"),
    ("bsd-2-clause", r"bsd", r"(?:simplified bsd|bsd 2[- ]clause)", r"bsd-2-clause"),
    ("bsd-3-clause", r"bsd", r"(?:(?:new|modified|revised) bsd|bsd 3[- ]clause)", r"bsd-3-clause"),
    ("bsl-1.0", r"boost", r"boost software", r"bsl-1\.0"),
    ("busl-1.1", r"business", r"business source", r"busl-1\.1"),
    ("cc-by-3.0", r"3.0", r"(?:cc[- ]by|creative commons attribution)[- ]3\.0", r"cc[- ]by[- ]3\.0"),
    ("cc-by-4.0", r"4.0", r"(?:cc[- ]by|creative commons attribution)[- ]4\.0", r"cc[- ]by[- ]4\.0"),
    ("cc-by-nc-4.0", r"4.0", r"(?:cc[- ]by[- ]nc|creative commons attribution[- ]noncommercial)[- ]4\.0", r"cc[- ]by[- ]nc[- ]4\.0"),
    ("cc-by-nc-nd-4.0", r"4.0", r"(?:cc[- ]by[- ]nc[- ]nd|creative commons attribution[- ]noncommercial[- ]noderivatives)[- ]4\.0", r"cc[- ]by[- ]nc[- ]nd[- ]4\.0"),
    ("cc-by-nc-sa-4.0", r"4.0", r"(?:cc[- ]by[- ]nc[- ]sa|creative commons attribution[- ]noncommercial[- ]sharealike)[- ]4\.0", r"cc[- ]by[- ]nc[- ]sa[- ]4\.0"),
    ("cc-by-nd-4.0", r"4.0", r"(?:cc[- ]by[- ]nd|creative commons attribution[- ]noderivatives)[- ]4\.0", r"cc[- ]by[- ]nd[- ]4\.0"),
    ("cc-by-sa-3.0", r"3.0", r"(?:cc[- ]by[- ]sa|creative commons attribution[- ]sharealike)[- ]3\.0", r"cc[- ]by[- ]sa[- ]3\.0"),
    ("cc-by-sa-4.0", r"4.0", r"(?:cc[- ]by[- ]sa|creative commons attribution[- ]sharealike)[- ]4\.0", r"cc[- ]by[- ]sa[- ]4\.0"),
    ("cc0-1.0", r"cc0", r"cc0(?: 1\.0)?(?: universal)?", r"cc0(?:-1\.0)?"),
    ("cddl-1.0", r"common development", r"common development and distribution", r"cddl-1\.0"),
    ("cecill-2.1", r"cecill", r"cecill", r"cecill-2\.1"),
    ("cpl-1.0", r"common public", r"common public", r"cpl-1\.0"),
    ("ecl-2.0", r"educational", r"educational community", r"ecl-2\.0"),
    ("epl-2.0", r"eclipse", r"eclipse public", r"epl(?:v2|-2\.0)"),
    ("eupl-1.2", r"european", r"european union public", r"eupl-1\.2"),
    ("gfdl-1.3", r"free documentation", r"(?:gnu )?free documentation", r"gfdl(?:-1\.3)?"),
    ("gpl-2.0", r"general public", r"(?:gnu )?general public(?= licen[cs]e,? (?:version|v\.?) ?2)", r"gpl(?:v2|-2\.0)"),
    ("gpl-3.0", r"general public", r"(?:gnu )?general public(?= licen[cs]e,? (?:version|v\.?) ?3)", r"gpl(?:v3|-3\.0)"),
    ("gpl", r"general public", r"(?:gnu )?general public", r"gnu gpl"),
    ("hpnd", r"historical", r"historical permission notice", r"hpnd"),
    ("isc", r"isc", r"isc", ""),
    ("lgpl-2.1", r"lesser", r"(?:gnu )?lesser general public(?= licen[cs]e,? (?:version|v\.?) ?2)", r"lgpl(?:v2\.1|-2\.1)"),
    ("lgpl-3.0", r"lesser", r"(?:gnu )?lesser general public(?= licen[cs]e,? (?:version|v\.?) ?3)", r"lgpl(?:v3|-3\.0)"),
    ("lgpl", r"lesser", r"(?:gnu )?lesser general public", r"gnu lgpl"),
    ("lppl-1.3c", r"latex", r"latex project public", r"lppl"),
    ("mit", r"mit", r"(?:the )?mit", ""),
    ("mpl-1.1", r"mozilla", r"mozilla public(?= licen[cs]e,? (?:version|v\.?) ?1)", r"mpl-1\.1"),
    ("mpl-2.0", r"mozilla", r"mozilla public", r"mpl-2\.0"),
    ("ms-pl", r"microsoft", r"microsoft public", r"ms-pl"),
    ("ncsa", r"ncsa", r"(?:university of illinois/)?ncsa open source", r"ncsa"),
    ("odbl-1.0", r"open database", r"open (?:data commons open )?database", r"odbl"),
    ("ofl-1.1", r"open font", r"(?:sil )?open font", r"ofl-1\.1"),
    ("osl-3.0", r"open software", r"open software", r"osl-3\.0"),
    ("postgresql", r"postgresql", r"postgresql", ""),
    ("python-2.0", r"python", r"python software foundation", r"psf-2\.0"),
    ("unlicense", r"unlicense", r"unlicense", r"unlicense"),
    ("upl-1.0", r"universal permissive", r"universal permissive", r"upl-1\.0"),
    ("wtfpl", r"wtfpl", r"wtfpl", r"wtfpl"),
    ("zlib", r"zlib", r"zlib", ""),
)
_AS_PUBLISHED = " as published by the free software foundation[;,]? "
_GAP = r"[\s\S]{0,1600}?"  # to a clause further down in the same text
# Signatures of license texts and notices: label, priority, a
# keyword that every match contains, pattern (a space stands for white space
# and comment marks).
SIGNATURES = (
    # permissive texts
    ("mit", 92, "obtaining", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit-0", 94, "obtaining", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
     r" \(the .software.\), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish,"
     r" distribute, sublicense, and.or sell copies of the software, and to permit persons to whom the software is furnished to do so\. the software is provided"),
    ("x11", 95, "consortium", r"permission is hereby granted, free of charge, to any person obtaining a copy" + _GAP + r"except as contained in this notice, the name of the x consortium"),
    ("bsl-1.0", 95, "organization", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"),
    ("isc", 94, "permission", r"permission to use, copy, modify,? (?:and.or|and) distribute this software for any purpose with or without fee is hereby granted, provided that the above"
     r" copyright notice and this permission notice appear in all copies"),
    ("0bsd", 90, "permission", r"permission to use, copy, modify,? and.or distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", 91, "permission", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted"),
    ("bsd-1-clause", 84, "redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions? (?:are|is) met"),
    ("bsd-2-clause", 90, "redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted" + _GAP
     + r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 93, "endorse", r"redistribution and use in source and binary forms, with or without modification, are permitted" + _GAP
     + r"(?:neither the names? of|the names? of)" + r"[\s\S]{0,300}?" + r"endorse or promote products"),
    ("bsd-4-clause", 95, "advertising", r"redistribution and use in source and binary forms, with or without modification, are permitted" + _GAP
     + r"all advertising materials mentioning features" + _GAP + r"endorse or promote products"),
    ("bsd-3-clause-clear", 96, "patent", r"redistribution and use in source and binary forms, with or without modification, are permitted \(subject to the limitations in the disclaimer below\)"
     + _GAP + r"no express or implied licenses to any party's patent rights"),
    ("zlib", 93, "altered", r"altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("libpng", 95, "contributing", r"the contributing authors and .{0,40}disclaim all warranties, expressed or implied" + _GAP + r"altered versions must be plainly marked"),
    ("unlicense", 95, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", 95, "everyone", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed"),
    ("beerware", 95, "beer", r"if we meet some day, and you think this stuff is worth it, you can buy me a beer"),
    ("postgresql", 95, "documentation", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("python-2.0", 94, "python", r"this license agreement is between the python software foundation"),
    ("ncsa", 95, "disclaimers", r"to deal with the software without restriction" + _GAP + r"redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimers"),
    ("ncsa", 94, "deal", r"to deal with the software without restriction, including without limitation the rights to use"),
    ("artistic-1.0", 93, "artistic", r"the intent of this document is to state the conditions under which a package may be copied, such that the copyright holder maintains some semblance of artistic control"),
    ("artistic-2.0", 93, "artistic", r"the artistic license 2\.0"),
    ("openssl", 95, "openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("curl", 95, "permission", r"permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice"
     r" and this permission notice appear in all copies\. the software is provided .as is., without warranty of any kind, express or implied, including but not limited to the"
     r" warranties of merchantability, fitness for a particular purpose and noninfringement of third party rights"),
    ("ofl-1.1", 94, "font", r"sil open font license version 1\.1"),
    ("ofl-1.1", 94, "font", r"the font software may be sold as part of a larger software package but no copy of one or more of the font software typefaces may be sold by itself"),
    ("cc0-1.0", 95, "affirmer", r"to the greatest extent permitted by, but not in contravention of, applicable law, affirmer hereby overtly, fully, permanently"),
    ("cc0-1.0", 90, "waiv", r"(?:has|have) (?:dedicated the work to the public domain by waiving|waived) all (?:of )?(?:his or her |their )?(?:copyright|rights)"),
    ("upl-1.0", 94, "universal", r"the universal permissive license \(upl\),? version 1\.0"),
    ("afl-3.0", 94, "academic", r"licensed under the academic free license version 3\.0"),
    ("osl-3.0", 94, "open", r"licensed under the open software license version 3\.0"),
    # apache
    ("apache-2.0", 94, "january", r"apache license,? version 2\.0, january 2004"),
    ("apache-2.0", 93, "compliance", r"licensed (?:to .{1,80} )?under the apache license, version 2\.0 \(the .?license.?\);? you may not use this file except in compliance with the license"),
    ("apache-2.0", 88, "perpetual", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce"),
    ("apache-1.1", 94, "apache", r"apache (?:software )?licen[cs]e,? (?:version |v\.? ?)?1\.1"),
    ("apache-1.0", 94, "apache", r"apache (?:software )?licen[cs]e,? (?:version |v\.? ?)?1\.0"),
    ("apache-1.1", 95, "acknowledgment", r"this product includes software developed by the apache software foundation" + _GAP + r"alternately, this acknowledgment may appear"),
    ("ecl-2.0", 94, "educational", r"licensed under the educational community license, version 2\.0"),
    # gnu: titles with dates, notices with versions
    ("gpl-1.0", 95, "february", r"gnu general public license version 1, february 1989"),
    ("gpl-2.0", 95, "june", r"gnu general public license version 2, june 1991"),
    ("gpl-3.0", 95, "june", r"gnu general public license version 3, 29 june 2007"),
    ("lgpl-2.0", 95, "june", r"gnu library general public license version 2, june 1991"),
    ("lgpl-2.1", 95, "february", r"gnu lesser general public license version 2\.1, february 1999"),
    ("lgpl-3.0", 95, "june", r"gnu lesser general public license version 3, 29 june 2007"),
    ("agpl-3.0", 95, "november", r"gnu affero general public license version 3, 19 november 2007"),
    ("gfdl-1.1", 95, "march", r"gnu free documentation license version 1\.1, march 2000"),
    ("gfdl-1.2", 95, "november", r"gnu free documentation license version 1\.2, november 2002"),
    ("gfdl-1.3", 95, "november", r"gnu free documentation license version 1\.3, 3 november 2008"),
    ("gpl-1.0", 94, "published", r"gnu general public license" + _AS_PUBLISHED + r"(?:either )?version 1(?![0-9.])"),
    ("gpl-2.0", 94, "published", r"gnu general public license" + _AS_PUBLISHED + r"(?:either )?version 2(?![0-9.])"),
    ("gpl-3.0", 94, "published", r"gnu general public license" + _AS_PUBLISHED + r"(?:either )?version 3(?![0-9.])"),
    ("gpl-2.0", 93, "version", r"gnu general public license,? version 2(?![0-9])" + _AS_PUBLISHED.rstrip()),
    ("gpl-3.0", 93, "version", r"gnu general public license,? version 3(?![0-9])" + _AS_PUBLISHED.rstrip()),
    ("lgpl-2.0", 94, "published", r"gnu library general public license" + _AS_PUBLISHED + r"(?:either )?version 2(?![0-9.])"),
    ("lgpl-2.1", 94, "published", r"gnu lesser general public license" + _AS_PUBLISHED + r"(?:either )?version 2\.1"),
    ("lgpl-3.0", 94, "published", r"gnu lesser general public license" + _AS_PUBLISHED + r"(?:either )?version 3(?![0-9.])"),
    ("agpl-3.0", 94, "published", r"(?:gnu )?affero general public license" + _AS_PUBLISHED + r"(?:either )?version 3(?![0-9.])"),
    ("gfdl-1.1", 93, "documentation", r"gnu free documentation license, version 1\.1"),
    ("gfdl-1.2", 93, "documentation", r"gnu free documentation license, version 1\.2"),
    ("gfdl-1.3", 93, "documentation", r"gnu free documentation license, version 1\.3"),
    ("gpl", 70, "freedom", r"the licenses for most software(?: and other practical works)? are designed to take away your freedom to share and change (?:it|the works)"),
    ("lgpl", 70, "linking", r"a .work that uses the library. by linking"),
    ("gpl-3.0", 45, "either", r"either version 3 of the license, or \(at your option\) any later version"),
    ("gpl-2.0", 45, "either", r"either version 2 of the license, or \(at your option\) any later version"),
    ("lgpl-2.1", 45, "either", r"either version 2\.1 of the license, or \(at your option\) any later version"),
    # weak copyleft
    ("mpl-2.0", 94, "source", r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0"),
    ("mpl-2.0", 93, "mozilla", r"mozilla public license,? version 2\.0"),
    ("mpl-1.1", 94, "mozilla", r"the contents of this file are subject to the mozilla public license,? version 1\.1"),
    ("mpl-1.0", 94, "mozilla", r"the contents of this file are subject to the mozilla public license,? version 1\.0"),
    ("epl-2.0", 94, "eclipse", r"made available under the terms of the eclipse public license,? (?:version |v\.? ?)?2\.0"),
    ("epl-1.0", 94, "eclipse", r"made available under the terms of the eclipse public license,? (?:version |v\.? ?)?1\.0"),
    ("epl-1.0", 93, "eclipse", r"eclipse public license ?- ?v ?1\.0"),
    ("epl-2.0", 93, "eclipse", r"eclipse public license ?- ?v ?2\.0"),
    ("cpl-1.0", 93, "common", r"common public license ?(?:version |- ?v ?)1\.0"),
    ("ipl-1.0", 93, "ibm", r"ibm public license version 1\.0"),
    ("cddl-1.0", 94, "development", r"subject to the terms of the common development and distribution license,? (?:version 1\.0|\(the .license.\))"),
    ("cddl-1.1", 94, "development", r"common development and distribution license \(cddl\) version 1\.1"),
    ("cecill-2.1", 93, "cecill", r"cecill free software license agreement,? version 2\.1"),
    ("cecill-b", 94, "cecill", r"cecill-b free software license agreement"),
    ("cecill-c", 94, "cecill", r"cecill-c free software license agreement"),
    ("eupl-1.1", 94, "european", r"european union public licen[cs]e,? (?:version |v\.? ?)1\.1"),
    ("eupl-1.2", 94, "european", r"european union public licen[cs]e,? (?:version |v\.? ?)1\.2"),
    ("ms-pl", 94, "microsoft", r"microsoft public license \(ms-pl\)"),
    ("ms-rl", 94, "microsoft", r"microsoft reciprocal license \(ms-rl\)"),
    ("lppl-1.3c", 94, "latex", r"conditions of the latex project public license, either version 1\.3c?"),
    ("ruby", 94, "ruby", r"you may distribute the software in object code or binary form, provided that you do at least one of the following" + _GAP + r"ruby"),
    ("vim", 94, "vim", r"there are no restrictions on distributing unmodified copies of vim"),
    ("sleepycat", 95, "accompanied", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("qpl-1.0", 94, "public", r"the q public license version 1\.0"),
    ("watcom-1.0", 94, "sybase", r"sybase open watcom public license version 1\.0"),
    ("apsl-2.0", 94, "apple", r"apple public source license version 2\.0"),
    ("nasa-1.3", 94, "nasa", r"nasa open source agreement version 1\.3"),
    ("rpl-1.5", 94, "reciprocal", r"reciprocal public license,? (?:version )?1\.5"),
    ("sspl-1.0", 94, "server", r"server side public license,? version 1"),
    ("elastic-2.0", 94, "elastic", r"elastic license 2\.0"),
    ("busl-1.1", 94, "business", r"business source license 1\.1"),
    ("commons-clause", 94, "commons", r".commons clause. license condition v1\.0"),
    ("json", 95, "evil", r"the software shall be used for good, not evil"),
    ("odbl-1.0", 94, "database", r"open database license \(odbl\) v1\.0"),
    ("odc-by-1.0", 94, "attribution", r"open data commons attribution license"),
    ("pddl-1.0", 94, "dedication", r"public domain dedication (?:and|&) license"),
    ("cc-by-4.0", 94, "attribution", r"creative commons attribution 4\.0 international"),
    ("cc-by-sa-4.0", 94, "attribution", r"creative commons attribution-sharealike 4\.0 international"),
    ("cc-by-nc-4.0", 94, "attribution", r"creative commons attribution-noncommercial 4\.0 international"),
    ("cc-by-nd-4.0", 94, "attribution", r"creative commons attribution-noderivatives 4\.0 international"),
    ("cc-by-nc-sa-4.0", 94, "attribution", r"creative commons attribution-noncommercial-sharealike 4\.0 international"),
    ("cc-by-nc-nd-4.0", 94, "attribution", r"creative commons attribution-noncommercial-noderivatives 4\.0 international"),
    ("cc-by-3.0", 93, "attribution", r"creative commons attribution 3\.0 (?:unported|united states)"),
    ("cc-by-sa-3.0", 93, "attribution", r"creative commons attribution-share ?-?alike 3\.0 (?:unported|united states)"),
    ("cc-by-2.0", 93, "attribution", r"creative commons attribution 2\.0 generic"),
    ("cc-by-sa-2.0", 93, "attribution", r"creative commons attribution-sharealike 2\.0 generic"),
    ("openrail-m", 93, "creativeml", r"creativeml open rail-?m"),
    ("openrail-m", 92, "responsible", r"responsible ai licen[cs]e"),
)
# Acronyms that stand after "under (the)"; a version makes the label surer.
ACRONYMS = (
    ("gpl-2.0", r"gpl,? ?(?:version |v\.? ?)?2(?:\.0)?"), ("gpl-3.0", r"gpl,? ?(?:version |v\.? ?)?3(?:\.0)?"), ("gpl", r"gpl"),
    ("lgpl-2.1", r"lgpl,? ?(?:version |v\.? ?)?2\.1"), ("lgpl-2.0", r"lgpl,? ?(?:version |v\.? ?)?2(?:\.0)?"),
    ("lgpl-3.0", r"lgpl,? ?(?:version |v\.? ?)?3(?:\.0)?"), ("lgpl", r"lgpl"),
    ("agpl-3.0", r"agpl(?:,? ?(?:version |v\.? ?)?3(?:\.0)?)?"), ("gfdl", r"gfdl|gnu fdl"),
    ("mpl-2.0", r"mpl,? ?(?:version |v\.? ?)?2(?:\.0)?"), ("mpl-1.1", r"mpl,? ?(?:version |v\.? ?)?1\.1"), ("mpl", r"mpl"),
    ("epl-1.0", r"epl,? ?(?:version |v\.? ?)?1(?:\.0)?"), ("epl-2.0", r"epl,? ?(?:version |v\.? ?)?2(?:\.0)?"), ("epl", r"epl"),
    ("cddl-1.0", r"cddl"), ("eupl-1.2", r"eupl"), ("wtfpl", r"wtfpl"), ("cc0-1.0", r"cc0"), ("ofl-1.1", r"(?:sil )?ofl"),
)

# What may follow the identifiers of licenses in versions "only" or "or later".
GNU = ("agpl-3.0", "gfdl-1.3", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0")
_LATER = r"(?:-only|-or-later|\+)?"
# Forms of mention with their priority; {name}, {id}, {short}, {later}.
_VERSION = r"(?:,? (?:version|v\.?) ?[0-9]+(?:\.[0-9]+)*)?"
FORMS = (
    (100, r"spdx-license-identifier:[ (]*(?:[a-z0-9.+-]+[ )]+(?:or|and|with)[ (]+)*(?P<at>{id}{later})(?![a-z0-9.-])"),
    (97, r"(?<![a-z0-9])licen[cs]es?[\"']? ?[:=] ?[\"'(\[]*(?P<at>{id}{later})(?![a-z0-9.-])"),
    (90, r"(?:opensource\.org/licen[cs]es?|choosealicense\.com/licenses|spdx\.org/licenses)/{id}{later}(?![a-z0-9-])"),
    (80, r"(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?" + _VERSION),
    (60, r"(?<![a-z0-9]){name} licen[cs]e(?![a-z0-9])" + _VERSION),
    (40, r"(?<![a-z0-9-]){short}{later}(?![a-z0-9-])"),
)
# Base phrases and their labels.
PHRASES = ((b" mit license ", "mit"), (b" apache license ", "apache"), (b" general public license ", "gpl"))
BASE_PRIORITY = 50
_WORD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: re.Pattern


def _spaced(pattern: str, marks: str = "") -> str:
    """A space in a pattern stands for any white space (or ``marks``), outside
    of classes."""
    return re.sub(r"(\[[^\]]*\])| \?| ", lambda m: m[1] or rf"[\x20\x09-\x0D{marks}]" + ("*" if m[0] == " ?" else "+"), pattern)


@cache
def rules() -> tuple[Rule, ...]:
    out = []
    for label, keyword, name, short in LICENSES:
        for priority, form in FORMS:
            if "{short}" in form and not short:
                continue
            keywords = (keyword.split()[0],) if "{name}" in form else \
                (re.match(r"[a-z0-9]+", label)[0],) if "licen[cs]es?" in form and "{id}" in form and "org" not in form else \
                ("license-identifier", "opensource.org", "choosealicense.com", "spdx.org") if "{id}" in form else \
                tuple({re.match(r"[a-z0-9]+", short)[0]})
            later = "" if label not in GNU else r"(?:-(?:no-)?invariants)?" + _LATER if label == "gfdl-1.3" else _LATER
            filled = form.format(id=re.escape(label), name=name, short=short, later=later)
            out.append(Rule(label, priority, keywords, re.compile(_spaced(filled))))
    for label, priority, keyword, pattern in SIGNATURES:
        out.append(Rule(label, priority, (keyword,), re.compile(_spaced(pattern, "*#/;"))))
    for label, short in ACRONYMS:
        priority = 75 if re.search("[0-9]", label) else 55
        keywords = ("gfdl", "fdl") if label == "gfdl" else (re.sub(r"\(.*?\)\?", "", short)[:3],)
        out.append(Rule(label, priority, keywords, re.compile(_spaced(
            rf"under (?:the )?(?:terms of (?:the )?)?(?:gnu )?(?:{short})(?![a-z0-9.-]*[a-z0-9])"))))
    return tuple(out)


@cache
def _prefilter():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in {k for r in rules() for k in r.keywords}:
        found.add_word(word, word)
    found.make_automaton()
    return found


def resolve(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Drop detections (start, end, priority, label) that lie within one of
    equal or higher priority; the first in rule order stays of equal ones."""
    kept: list[tuple[int, int, int, str]] = []
    starts, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for priority in sorted({f[2] for f in found}, reverse=True):
        edge = -1
        for f in sorted((f for f in found if f[2] == priority), key=lambda f: (f[0], -f[1])):
            at = int(np.searchsorted(starts, f[0], "right")) - 1
            if f[1] > edge and (at < 0 or far[at] < f[1]):
                kept.append(f)
                edge = f[1]
        kept.sort(key=lambda f: (f[0], -f[1]))
        starts = np.array([f[0] for f in kept], np.int64)
        far = np.maximum.accumulate(np.array([f[1] for f in kept], np.int64))
    return kept


def places(rule: Rule, text: str) -> list[tuple[int, int, int, str]]:
    """What a rule finds by itself; of tags the identifier is the place."""
    group = "at" if "at" in rule.pattern.groupindex else 0
    return [(*m.span(group), rule.priority, rule.label) for m in rule.pattern.finditer(text)]


def detections(text: str) -> list[tuple[int, int, int, str]]:
    """Resolved detections in a lower-case text: start, end, priority, label."""
    seen = {word for _, word in _prefilter().iter(text)}
    if not seen:
        return []
    return resolve([found for r in rules() if not seen.isdisjoint(r.keywords) for found in places(r, text)])


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """First word and label of each place where a base phrase stands."""
    line, out = b" " + b" ".join(words) + b" ", []
    for phrase, label in PHRASES:
        at, word, last = line.find(phrase), 0, 0
        while at >= 0:
            word, last = word + line.count(b" ", last, at), at
            out.append((word, label))
            at = line.find(phrase, at + 1)
    return out


_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double, detections array<struct<start:int,end:int,priority:int,label:string>>")


def _scanned(raw: bytes) -> tuple:
    low = raw.lower()
    words = low.translate(_WORD).split()
    base = base_places(words) if b"license" in low else []
    found = detections(low.decode())
    at, names = [w for w, _ in base], {x for _, x in base}
    score = max([f[2] for f in found] + [BASE_PRIORITY] * bool(base), default=0) / 100
    return (len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(names)),
            ",".join(sorted(names | {f[3] for f in found})), score,
            [dict(zip(("start", "end", "priority", "label"), f)) for f in found])


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document; offsets of detections count code points."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in batches:
            columns = list(zip(*map(_scanned, batch["raw"].to_pylist()))) or [()] * 8
            kind = kind or pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("priority", pa.int32()),
                                               ("label", pa.string())]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), kind]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, kinds))], names)

    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("raw")
    return map_arrow(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), raw), run, _SCHEMA)
