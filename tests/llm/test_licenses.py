import re

from ledgerline.llm import licenses
from tests.llm import cases

TEXTS = ["Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
         "Licensed under the\nApache  License, Version 2.0.", "Released under the MIT License. mit license-mit license", "MIT licensee",
         "SPDX-License-Identifier: GPL-2.0", "see GPLv3 or MPL-2.0", "https://opensource.org/licenses/MIT", "general public license general public license é",
         "GNU Lesser General Public License v2.1", "the amit license", "apache LICENSEé apache license"]


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    places = [(i, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_columns_and_labels(spark):
    data = cases.rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(TEXTS)]
    got = licenses.scan(cases.docs(spark, data)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels) for r in got) == \
        sorted((str(r[0]), *[str(x) if i in (2, 3) else x for i, x in enumerate(plain(r[1]))]) for r in data)
    label = {r.doc_id: r.labels for r in got if r.doc_id}
    assert [label[100 + i] for i in range(len(TEXTS))] == [
        "cc-by-nc-4.0", "gpl,gpl-3.0", "apache,apache-2.0", "mit", "", "gpl-2.0", "gpl-3.0,mpl-2.0", "mit", "gpl", "gpl,lgpl-2.1", "",
        "apache,apache-2.0"]
    assert all(0 <= r.score <= 1 and bool(r.labels) == (r.score > 0) for r in got)
    assert licenses.scan(cases.docs(spark, [])).count() == 0


def test_priorities_and_containment():
    found = [(0, 30, 80, "a"), (10, 25, 60, "b"), (10, 25, 80, "c"), (5, 40, 60, "d"), (6, 39, 40, "e"), (50, 60, 40, "f"), (50, 60, 40, "g")]
    assert sorted(x[3] for x in licenses.resolve(found)) == ["a", "d", "f"]
    assert len(licenses.rules()) >= 400 and all(r.keywords for r in licenses.rules())


def test_prefilter_loses_no_detection():
    for text in TEXTS:
        low = text.lower()
        all_rules = licenses.resolve([found for r in licenses.rules() for found in licenses.places(r, low)])
        assert sorted(licenses.detections(low)) == sorted(all_rules)


def alternatives(pattern):
    """What a name or short form matches: one text per branch and option, look-aheads left out."""
    def texts(tree):
        out = [""]
        for op, arg in tree:
            if str(op) == "LITERAL":
                some = [chr(arg)]
            elif str(op) == "IN":
                some = [chr(a) for _, a in arg]
            elif str(op) == "SUBPATTERN":
                some = texts(arg[3])
            elif str(op) == "BRANCH":
                some = [t for branch in arg[1] for t in texts(branch)]
            elif str(op) == "MAX_REPEAT":
                some = [""] * (arg[0] == 0) + texts(arg[2])
            else:
                assert str(op) == "ASSERT"
                some = [""]
            out = [a + b for a in out for b in some]
        return out
    return texts(re._parser.parse(pattern))


def test_prefilter_loses_no_alternative():
    """Each alternative of each license, in each form."""
    for label, _, name, short in licenses.LICENSES:
        texts = [form.format(n, version) for n in alternatives(name) for version in ("1.0", "2.0", "3.0")
                 for form in ("released under the {} license, version {}.", "x {} license v{} y", "{} license")]
        texts += [f"see {s} here" for s in alternatives(short) if short]
        texts += [f"spdx-license-identifier: {label}", f'license = "{label}"', f"https://spdx.org/licenses/{label}.html", f"opensource.org/license/{label}"]
        seen = set()
        for low in texts:
            found = [found for r in licenses.rules() for found in licenses.places(r, low)]
            seen |= {f[2] for f in found if f[3] == label}
            assert sorted(licenses.detections(low)) == sorted(licenses.resolve(found)), low
        assert seen >= {p for p, form in licenses.FORMS if short or "{short}" not in form}, label
    for text, label in (("Simplified BSD", "bsd-2-clause"), ("New BSD", "bsd-3-clause"), ("Modified BSD", "bsd-3-clause"), ("Revised BSD", "bsd-3-clause")):
        assert [f[3] for f in licenses.detections(f"Released under the {text} License.".lower())] == [label]


def test_current_tags_of_the_gnu_family():
    for label in ("gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "gfdl-1.3"):
        for tail in ("", "-only", "-or-later", "+"):
            tag = label.upper() + tail
            for priority, text in ((100, f"SPDX-License-Identifier: {tag}"), (100, f"// SPDX-License-Identifier:{tag} WITH x"),
                                   (90, f"https://spdx.org/licenses/{tag}.html"), (40, f"under {tag}, as is")):
                got = licenses.detections(text.lower())
                assert [f[2:] for f in got] == [(priority, label)], text
                assert text.lower()[got[0][0]:got[0][1]].endswith(tag.lower())
            for text in (f"SPDX-License-Identifier: {label}-onlyx", f"SPDX-License-Identifier: {label}-other", f"{label}-or-laterish"):
                assert licenses.detections(text) == []
    assert [f[3] for f in licenses.detections("spdx-license-identifier: gfdl-1.3-no-invariants-or-later")] == ["gfdl-1.3"]
    assert licenses.detections("spdx-license-identifier: mit-only") == []


BSD = """Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:
 * 1. Redistributions of source code must retain the above copyright notice.
 * 2. Redistributions in binary form must reproduce the above copyright notice."""
THIRD = """
 * 3. Neither the name of the University nor the names of its contributors may
 *    be used to endorse or promote products derived from this software."""
FOURTH = """
 * 3. All advertising materials mentioning features or use of this software must display
 * 4. Neither the name of the University may be used to endorse or promote products"""
SIGNED = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal", "mit"),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and", "bsl-1.0"),
    (BSD, "bsd-2-clause"), (BSD + THIRD, "bsd-3-clause"), (BSD + FOURTH, "bsd-4-clause"), (BSD.split("2.")[0], "bsd-1-clause"),
    ("# Permission to use, copy, modify, and/or distribute this software for any\n# purpose with or without fee is hereby granted, provided that the above\n"
     "# copyright notice and this permission notice appear in all copies.", "isc"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "0bsd"),
    ('license = "MIT"', "mit"), ('"license": "Apache-2.0",', "apache-2.0"), ("License: GPL-3.0-or-later", "gpl-3.0"),
    ("Licensed under the MPL 2.0", "mpl-2.0"), ("under the LGPL", "lgpl"), ("released under the GPL", "gpl"), ("under the terms of the GPL v2.", "gpl-2.0"),
    ("under the GNU LGPL, version 2.1", "lgpl-2.1"),
    ("it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version", "gpl,gpl-3.0"),
    ("the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License", "gpl,lgpl-2.1"),
    ("GNU Affero General Public License as published by the Free Software Foundation, either version 3", "agpl-3.0,gpl"),
    ("Apache License 1.1", "apache,apache-1.1"), ("The Apache Software License, Version 1.1", "apache-1.1"),
    ("Apache License\n   Version 2.0, January 2004", "apache,apache-2.0"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");\n you may not use this file except in compliance with the License.", "apache,apache-2.0"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2.0,mit"), ("SPDX-License-Identifier: (MIT AND BSD-3-Clause)", "bsd-3-clause,mit"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.", "mpl-2.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.", "zlib"),
    ("made available under the terms of the Eclipse Public License v1.0", "epl-1.0"),
    ("The Software shall be used for Good, not Evil.", "json"),
]


def test_signatures_of_texts_and_notices(spark):
    docs = cases.docs(spark, [(i, t, "en", "s", 1) for i, (t, _) in enumerate(SIGNED)])
    got = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(SIGNED)] == SIGNED


def test_plain_search_over_all_rules_gives_the_same_labels():
    texts = [t for t, _ in SIGNED] + TEXTS + ["\n".join(t for t, _ in SIGNED[i::3]) for i in range(3)]
    for text in texts:
        low = text.lower()
        everything = licenses.resolve([found for r in licenses.rules() for found in licenses.places(r, low)])
        assert sorted(licenses.detections(low)) == sorted(everything)


def surely_holds(tree, word):
    """Whether every match of a parsed pattern contains ``word``."""
    run, runs = "", []
    for op, arg in tree:
        if str(op) == "LITERAL":
            run += chr(arg)
            continue
        runs.append(run)
        run = ""
        if str(op) == "SUBPATTERN" and surely_holds(arg[3], word):
            return True
        if str(op) == "BRANCH" and all(surely_holds(b, word) for b in arg[1]):
            return True
        if str(op) in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0 and surely_holds(arg[2], word):
            return True
    return any(word in r for r in [*runs, run])


def test_every_match_of_a_signature_holds_its_keyword():
    for label, _, keyword, pattern in licenses.SIGNATURES:
        assert surely_holds(re._parser.parse(pattern), keyword), label


def test_long_texts_are_linear():
    import time
    took = []
    for n in (20_000, 160_000):
        text = ("redistribution and use in source and binary forms, with or without modification, are permitted " * (n // 100)).lower()
        start = time.perf_counter()
        licenses.detections(text)
        took.append(time.perf_counter() - start)
    assert took[1] < 8 * 4 * took[0] + 1
