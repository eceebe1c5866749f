"""Whole notices, titles and identifiers of many licenses; suppression against brute force; long texts."""

import random
import time

import pytest

from tidemark.llm import licenses

GNU = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; {}.\nThis program is distributed in the hope that it will be useful."
LATER = "either version {} of the License, or (at your option) any later version"
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights",
    "mit-0": "SPDX-License-Identifier: MIT-0",
    "x11": "Released under the X11 license.",
    "apache-2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n  http://www.apache.org/licenses/LICENSE-2.0",
    "apache-1": "The Apache Software License, Version 1.1",
    "apache": "under an Apache License of some kind",
    "gpl-1": GNU.format("General Public License", LATER.format(1)),
    "gpl-2-or-later": GNU.format("General Public License", LATER.format(2)),
    "gpl-3-or-later": GNU.format("General Public License", LATER.format(3)),
    "gpl-2-only": "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl-3-only": "SPDX-License-Identifier: GPL-3.0-only",
    "gpl-2": "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991",
    "gpl-3": "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007",
    "gpl": "You should have received a copy of the GNU General Public License along with this program.",
    "lgpl-2-or-later": GNU.format("Library General Public License", LATER.format(2)),
    "lgpl-2": "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl-2.1-or-later": GNU.format("Lesser General Public License", LATER.format("2.1")),
    "lgpl-2.1-only": "SPDX-License-Identifier: LGPL-2.1-only",
    "lgpl-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl-3-or-later": GNU.format("Lesser General Public License", LATER.format(3)),
    "lgpl-3-only": "LGPL v3 only",
    "lgpl-3": "This library is LGPL version 3.",
    "lgpl": "a copy of the GNU Lesser General Public License",
    "agpl-3-or-later": GNU.format("Affero General Public License", LATER.format(3)),
    "agpl-3-only": "SPDX-License-Identifier: AGPL-3.0-only",
    "agpl-3": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "agpl": "See the GNU Affero General Public License for more details.",
    "gfdl": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3",
    "bsd-2": "Distributed under the 2-clause BSD license.",
    "bsd-3": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-4": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice",
    "hpnd": "SPDX-License-Identifier: HPND",
    "mpl-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")",
    "mpl-1": "Mozilla Public License, version 1.0",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mpl": "some Mozilla Public License",
    "epl-1": "made available under the terms of the Eclipse Public License v1.0",
    "epl-2": "This program is made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "edl-1": "Eclipse Distribution License v. 1.0",
    "cddl-1": "Common Development and Distribution License (CDDL) Version 1.0",
    "cddl-1.1": "CDDL 1.1",
    "cpl-1": "Common Public License Version 1.0",
    "eupl-1.1": "EUPL v1.1",
    "eupl-1.2": "Licensed under the EUPL, version 1.2",
    "artistic-1": "Artistic License 1.0",
    "artistic-2": "The Artistic License 2.0",
    "artistic": "the Artistic License",
    "perl": "you can redistribute it and/or modify it under the same terms as Perl itself.",
    "zlib": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "libpng": "This code is released under the libpng license.",
    "boost-1": "Distributed under the Boost Software License, Version 1.0. (See http://www.boost.org/LICENSE_1_0.txt)",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "wtfpl": "WTFPL",
    "cc0": "CC0 1.0 Universal",
    "cc-by": "This work is licensed under a CC BY 4.0",
    "cc-by-sa": "https://creativecommons.org/licenses/by-sa/4.0/",
    "cc-by-nd": "Creative Commons Attribution-NoDerivs",
    "cc-by-nc-sa": "Creative Commons Attribution-NonCommercial-ShareAlike 3.0",
    "cc-by-nc-nd": "https://creativecommons.org/licenses/by-nc-nd/4.0/",
    "ofl-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "odbl": "made available under the Open Database License",
    "odc-by": "Open Data Commons Attribution License",
    "pddl": "Open Data Commons Public Domain Dedication and License",
    "ms-pl": "Microsoft Public License (Ms-PL)",
    "ms-rl": "Microsoft Reciprocal License",
    "python-2": "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2",
    "php-3": "This source file is subject to version 3.01 of the PHP license",
    "ruby": "under the same terms as Ruby itself",
    "postgresql": "Released under the PostgreSQL License",
    "openssl": "This product includes software developed by the OpenSSL Project",
    "ncsa": "University of Illinois/NCSA Open Source License",
    "upl-1": "Licensed under the Universal Permissive License v 1.0",
    "osl-3": "Open Software License (OSL) v. 3.0",
    "afl-3": "Licensed under the Academic Free License version 3.0",
    "sspl-1": "Server Side Public License, version 1",
    "busl-1.1": "Business Source License 1.1",
    "elastic-2": "Licensed under the Elastic License 2.0",
    "cecill-2.1": "governed by the CeCILL license under French law",
    "mulan-psl-2": "is licensed under Mulan PSL v2.",
    "public-domain": "The author has placed in the public domain all of it. In the public domain.",
    "proprietary": "Unauthorized copying of this file, via any medium is strictly prohibited. Proprietary and confidential",
    "all-rights-reserved": "Copyright 2020. All rights reserved.",
}


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


@pytest.mark.parametrize("label", NOTICES)
def test_notices_get_their_label_alone(scanner, label):
    assert scanner.scan(NOTICES[label])["labels"] == label


def test_forms_of_one_family_are_told_apart(scanner):
    for text, label in {
        "GPL-2.0-or-later": "gpl-2-or-later", "GPLv3 or later": "gpl-3-or-later", "GNU GPL v2 only": "gpl-2-only",
        "SPDX-License-Identifier: GPL-2.0-only": "gpl-2-only", "SPDX-License-Identifier: LGPL-3.0-or-later": "lgpl-3-or-later",
        "mpl 2 5": "", "a permit to commit": "", "we saw the general public": "",
    }.items():
        assert scanner.scan(text)["labels"] == label, text


def test_every_label_and_rule_is_listed_once(scanner):
    rules = [(r.label, r.pattern.pattern) for r in scanner.rules]
    assert len(rules) == len(set(rules)) and len(rules) > 300
    for phrase, _ in licenses.BASE_PHRASES:
        assert scanner.keywords & set(phrase.split())


def test_suppression_equals_a_pairwise_check(scanner):
    pieces = [" ".join(w.decode() for w in licenses._WORD.findall(t.encode().lower())) for t in NOTICES.values()]
    mixed = random.Random(4)
    for _ in range(20):
        joined = " ".join(mixed.choice(pieces) for _ in range(12))
        every = {(m.start(), m.end(), r.tier, r.label) for r in scanner.rules if r.keywords & set(joined.split()) for m in r.pattern.finditer(joined)}
        kept = set()
        for a, b, tier, label in every:
            over = [(x, y, t, n) for x, y, t, n in every if x <= a and b <= y and t <= tier and (x, y, t, n) != (a, b, tier, label)]
            # Equal intervals of one tier: the first label stays.
            if all((x, y, t) == (a, b, tier) and n > label for x, y, t, n in over):
                kept.add((joined.count(" ", 0, a), joined.count(" ", 0, b) + 1, label))
        assert {(a, b, label) for a, b, label, _ in scanner.detections(joined)} == kept


def test_a_long_text_of_notices_takes_time_in_proportion(scanner):
    def seconds(n):
        text = "Licensed under the MIT license or GPL-2.0-only, see the BSD license. " * n
        start = time.process_time()
        out = scanner.scan(text)
        assert out["n_base"] == n and len(out["detections"].split(",")) == 3 * n
        return time.process_time() - start

    seconds(500)
    assert min(seconds(4_000), seconds(4_000)) <= 3 * min(seconds(2_000), seconds(2_000))
