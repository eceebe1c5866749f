"""Hand-written license signatures.

Each block starts with `= label : keywords`; the lines below are `tier regex`, over
lower-case words joined by single spaces ("GPL-2.0" is "gpl 2 0").  A block is tried only
on texts that hold one of its keywords as a word.
Names in braces stand for the fragments of FRAGMENTS.
"""

from __future__ import annotations

#: tier: weight.  0 identifiers and addresses, 1 grants, 2 sentences of the license's text,
#: 3 titles and references, 4 mentions, 5 hints.
TIERS = {0: 1.0, 1: 0.95, 2: 0.9, 3: 0.8, 4: 0.6, 5: 0.4}

FRAGMENTS = {
    "spdx": r"spdx license identifier",
    "given": r"(?:(?:is|are|be) )?(?:dual )?(?:licensed|released|distributed|redistributed|available|made available|published|provided|covered|governed|offered)(?: to you)? (?:under|by|subject to|in accordance with)(?: the)?(?: terms(?: and conditions)? of(?: the)?)?",
    "terms": r"(?:under|subject to|accept|by)(?: the)? (?:terms|conditions|provisions)(?: and conditions)? of(?: the| either the)?",
    "lic": r"licen[sc]e",
    "v": r"(?:version |v )?v?",
    # No further version digit: "mpl 2 5" is not version 2, "version 3 29 june 2007" is version 3.
    "end": r"(?! [0-9](?![^ ]))",
    "gpl": r"(?:gnu general public licen[sc]e(?: gnu gpl| gpl)?|(?:gnu )?gpl)",
    "lgpl": r"(?:gnu (?:lesser|library) (?:general public licen[sc]e|gpl)(?: gnu lgpl| lgpl)?|(?:gnu )?lgpl)",
    "agpl": r"(?:gnu affero (?:general public licen[sc]e|gpl)(?: gnu agpl| agpl)?|(?:gnu )?agpl)",
    "fsf": r"as published by the free software foundation",
    "later": r"or (?:at your option |at your choice )?(?:any )?(?:later|newer)(?: version)?",
    "cc": r"(?:cc|creative commons)",
    "ccv": r"(?: (?:[1-4] [05]))?(?: (?:international|unported|generic))?",
}

SIGNATURES = r"""
= mit : mit expat
0 {spdx} (?:mit|expat)
0 opensource org licenses mit(?: license)?(?: php| html)?
0 license (?:osi approved )?mit
1 {given} (?:mit|expat)(?: x11| style)?(?: {lic})?
1 {terms} (?:mit|expat)(?: x11)?(?: {lic})?
2 the mit license mit copyright
3 (?:see|read|refer to|view) the mit {lic}
3 the mit {lic}
3 mit {lic}(?: mit)?
3 expat {lic}
4 mit licen[sc]ed
4 mit(?= or apache)
4 (?<=2 0 or )mit
4 (?<=2 0 and )mit
= mit : hereby
2 permission is hereby granted free of charge to any person obtaining a copy
2 to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
2 the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
= mit-0 : mit
0 {spdx} mit 0
1 {given} mit (?:0|no attribution)(?: {lic})?
3 mit no attribution(?: {lic})?
= x11 : x11
0 {spdx} x11
1 {given} x11 {lic}
3 (?:the )?x11 {lic}
= apache-2 : apache apache2 asl
0 {spdx} apache 2 0
0 www apache org licenses license 2 0(?: txt| html)?
0 apache org licenses license 2 0
0 license (?:osi approved )?apache (?:software license )?2 0
1 {given} apache(?: software)?(?: {lic})? {v}2(?: 0)?{end}(?: {lic})?
1 {terms} apache(?: software)?(?: {lic})? {v}2(?: 0)?{end}(?: {lic})?
1 licensed to the apache software foundation asf under one or more contributor license agreements
2 apache license version 2 0 january 2004
2 you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org
3 (?:see|read|refer to) the apache(?: software)? {lic} {v}2(?: 0)?{end}
3 apache(?: software)? {lic} {v}2(?: 0)?{end}
4 apache {v}2(?: 0)?{end}
4 apache2
4 asl {v}2(?: 0)?{end}
= apache-1 : apache asl
0 {spdx} apache 1 [01]
1 {given} apache(?: software)?(?: {lic})? {v}1 [01]
3 apache(?: software)? {lic} {v}1 [01]
4 apache {v}1 [01]
= apache : apache
1 {given} apache(?: software)? {lic}
2 this product includes software developed by the apache (?:software foundation|group)
4 apache(?: software)? {lic}
= gpl-2-only : gnu gpl gplv2
0 {spdx} gpl 2 0 only
0 license gpl 2 0 only
1 {terms} {gpl} {v}2(?: 0)?{end} {fsf}
1 {terms} {gpl} {fsf} version 2 of the license(?! or)
1 (?:{terms} )?{gpl} {fsf} version 2(?: of the license)?(?! or| of the license or)
1 {given} {gpl} {v}2(?: 0)? only
3 {gpl} {v}2(?: 0)? only
3 gplv2 only
= gpl-2-or-later : gnu gpl gplv2
0 {spdx} gpl 2 0 or later
1 {terms} {gpl} {fsf} either version 2 of the license {later}
1 (?:{terms} )?{gpl} {fsf} (?:either )?version 2(?: of the license)? {later}
1 {given} {gpl} {v}2(?: 0)? {later}
3 {gpl} {v}2(?: 0)?(?: of the license)? {later}
3 gplv2 {later}
= gpl-2 : gnu gpl gplv2
0 {spdx} gpl 2 0
0 www gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?
0 opensource org licenses gpl 2 0
1 {given} {gpl} {v}2(?: 0)?{end}(?: {lic})?
1 {given} gplv2
1 {terms} {gpl} {v}2(?: 0)?{end}
2 gnu general public license version 2 june 1991
3 {gpl} {v}2(?: 0)?{end}
4 gplv2
= gpl-3-only : gnu gpl gplv3
0 {spdx} gpl 3 0 only
0 license gpl 3 0 only
1 {terms} {gpl} {v}3(?: 0)?{end} {fsf}
1 {terms} {gpl} {fsf} version 3 of the license(?! or)
1 (?:{terms} )?{gpl} {fsf} version 3(?: of the license)?(?! or| of the license or)
1 {given} {gpl} {v}3(?: 0)? only
3 {gpl} {v}3(?: 0)? only
3 gplv3 only
= gpl-3-or-later : gnu gpl gplv3
0 {spdx} gpl 3 0 or later
1 {terms} {gpl} {fsf} either version 3 of the license {later}
1 (?:{terms} )?{gpl} {fsf} (?:either )?version 3(?: of the license)? {later}
1 {given} {gpl} {v}3(?: 0)? {later}
3 {gpl} {v}3(?: 0)?(?: of the license)? {later}
3 gplv3 {later}
= gpl-3 : gnu gpl gplv3
0 {spdx} gpl 3 0
0 www gnu org licenses gpl 3 0(?: html| txt| en html)?
0 opensource org licenses gpl 3 0
1 {given} {gpl} {v}3(?: 0)?{end}(?: {lic})?
1 {given} gplv3
1 {terms} {gpl} {v}3(?: 0)?{end}
2 gnu general public license version 3 29 june 2007
2 the gnu general public license is a free copyleft license for software and other kinds of works
3 {gpl} {v}3(?: 0)?{end}
4 gplv3
= gpl-1 : gnu gpl
0 {spdx} gpl 1 0(?: only| or later)?
1 (?:{terms} )?{gpl} {fsf} either version 1(?: of the license)? {later}
3 {gpl} {v}1(?: 0)?{end}
= gpl : gnu gpl
1 {given} {gpl}
1 {terms} {gpl}
2 you should have received a copy of the gnu general public license along with this (?:program|file|software|library)
3 gnu general public {lic}
3 (?:gnu )?gpl {lic}
0 www gnu org (?:licenses|copyleft) gpl(?: html| txt)?
4 gnu gpl
= lgpl-2-or-later : gnu lgpl
0 {spdx} lgpl 2 0 or later
1 (?:{terms} )?{lgpl} {fsf} (?:either )?version 2(?: of the license)? {later}
3 {lgpl} {v}2(?: 0)? {later}
= lgpl-2 : gnu lgpl
0 {spdx} lgpl 2 0(?: only)?
2 gnu library general public license version 2 june 1991
3 {lgpl} {v}2(?: 0)?{end}
= lgpl-2.1-only : gnu lgpl lgplv2
0 {spdx} lgpl 2 1 only
1 {terms} {lgpl} {v}2 1 {fsf}
1 (?:{terms} )?{lgpl} {fsf} version 2 1(?: of the license)?(?! or| of the license or)
3 {lgpl} {v}2 1 only
= lgpl-2.1-or-later : gnu lgpl lgplv2
0 {spdx} lgpl 2 1 or later
1 {terms} {lgpl} {fsf} either version 2 1 of the license {later}
1 (?:{terms} )?{lgpl} {fsf} (?:either )?version 2 1(?: of the license)? {later}
1 {given} {lgpl} {v}2 1 {later}
3 {lgpl} {v}2 1(?: of the license)? {later}
= lgpl-2.1 : gnu lgpl lgplv2
0 {spdx} lgpl 2 1
0 www gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt)?
1 {given} {lgpl} {v}2 1
2 gnu lesser general public license version 2 1 february 1999
3 {lgpl} {v}2 1
3 lgplv2 1
= lgpl-3-only : gnu lgpl lgplv3
0 {spdx} lgpl 3 0 only
1 (?:{terms} )?{lgpl} {fsf} version 3(?: of the license)?(?! or| of the license or)
3 {lgpl} {v}3(?: 0)? only
= lgpl-3-or-later : gnu lgpl lgplv3
0 {spdx} lgpl 3 0 or later
1 {terms} {lgpl} {fsf} either version 3 of the license {later}
1 (?:{terms} )?{lgpl} {fsf} (?:either )?version 3(?: of the license)? {later}
1 {given} {lgpl} {v}3(?: 0)? {later}
3 {lgpl} {v}3(?: 0)? {later}
= lgpl-3 : gnu lgpl lgplv3
0 {spdx} lgpl 3 0
0 www gnu org licenses lgpl 3 0(?: html| txt)?
1 {given} {lgpl} {v}3(?: 0)?{end}
2 this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license
3 {lgpl} {v}3(?: 0)?{end}
4 lgplv3
= lgpl : gnu lgpl
1 {given} {lgpl}
1 {terms} {lgpl}
2 you should have received a copy of the gnu (?:lesser|library) general public license along with this (?:program|file|software|library)
3 gnu (?:lesser|library) general public {lic}
0 www gnu org (?:licenses|copyleft) (?:lgpl|lesser)(?: html| txt)?
4 lgpl
= agpl-3-only : gnu agpl agplv3
0 {spdx} agpl 3 0 only
1 (?:{terms} )?{agpl} {fsf} version 3(?: of the license)?(?! or| of the license or)
3 {agpl} {v}3(?: 0)? only
= agpl-3-or-later : gnu agpl agplv3
0 {spdx} agpl 3 0 or later
1 {terms} {agpl} {fsf} either version 3 of the license {later}
1 (?:{terms} )?{agpl} {fsf} (?:either )?version 3(?: of the license)? {later}
3 {agpl} {v}3(?: 0)? {later}
= agpl-3 : gnu agpl agplv3
0 {spdx} agpl 3 0
0 www gnu org licenses agpl 3 0(?: html| txt)?
1 {given} {agpl} {v}3(?: 0)?{end}
2 gnu affero general public license version 3 19 november 2007
3 {agpl} {v}3(?: 0)?{end}
4 agplv3
= agpl : gnu agpl
1 {given} {agpl}
1 {terms} {agpl}
2 you should have received a copy of the gnu affero general public license along with this (?:program|file|software|library)
3 gnu affero general public {lic}
4 agpl
= gfdl : gnu gfdl
0 {spdx} gfdl 1 [123](?: only| or later)?
1 permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
1 {given} gnu free documentation {lic}
3 gnu free documentation {lic}(?: {v}1 [123])?
4 gfdl
= bsd-2 : bsd freebsd
0 {spdx} bsd 2 clause(?: freebsd)?
0 opensource org licenses bsd 2 clause
1 {given} (?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd)(?: {lic})?
3 (?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd)(?: style)? {lic}
4 (?:bsd 2 clause|2 clause bsd)
= bsd-3 : bsd
0 {spdx} bsd 3 clause(?: clear)?
0 opensource org licenses bsd 3 clause
1 {given} (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: {lic})?
3 (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: style)? {lic}
4 (?:bsd 3 clause|3 clause bsd)
= bsd-3 : endorse
2 neither the names? of (?:the |its )?(?:[^ ]+ ){1,12}?may be used to endorse or promote products derived from this software without specific prior written permission
2 the names? of (?:the )?(?:authors?|contributors?) may not be used to endorse or promote products derived from this software
= bsd-4 : bsd
0 {spdx} bsd 4 clause(?: uc)?
1 {given} (?:original bsd|bsd 4 clause|4 clause bsd)(?: {lic})?
3 (?:original bsd|bsd 4 clause|4 clause bsd|old bsd) {lic}
= bsd-4 : advertising
2 all advertising materials mentioning features or use of this software must display the following acknowledge?ment
= bsd : bsd 0bsd
1 {given} bsd(?: style)?(?: {lic})?
3 (?:see|read) the bsd {lic}
4 bsd(?: style)? {lic}
4 bsd licen[sc]ed
0 {spdx} 0bsd
= bsd : redistribution
2 redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
2 redistributions? of source code must retain the above copyright notice this list of conditions and the following disclaimer
= isc : isc
0 {spdx} isc
0 opensource org licenses isc(?: license)?
1 {given} isc(?: {lic})?
3 (?:the )?isc {lic}
= isc : fee
2 permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
2 permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
= hpnd : fee hpnd
0 {spdx} hpnd
2 permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:is hereby granted )?(?:and )?without fee
= mpl-1.1 : mozilla mpl
0 {spdx} mpl 1 1
0 www mozilla org mpl mpl 1 1
1 the contents of this file are subject to the mozilla public license version 1 1
1 {given} (?:mozilla public {lic}|mpl) {v}1 1
3 (?:mozilla public {lic}|mpl) {v}1 1
= mpl-1 : mozilla mpl
0 {spdx} mpl 1 0
3 (?:mozilla public {lic}|mpl) {v}1 0
= mpl-2 : mozilla mpl
0 {spdx} mpl 2 0(?: no copyleft exception)?
0 mozilla org mpl 2 0
1 this source code form is subject to the terms of the mozilla public license v 2 0
1 {given} (?:mozilla public {lic}|mpl) {v}2(?: 0)?{end}
1 {terms} (?:mozilla public {lic}|mpl) {v}2(?: 0)?{end}
2 if a copy of the mpl was not distributed with this file you can obtain one at
3 (?:mozilla public {lic}|mpl) {v}2(?: 0)?{end}
= mpl : mozilla mpl
1 {given} mozilla public {lic}
4 mozilla public {lic}
= epl-1 : eclipse epl
0 {spdx} epl 1 0
0 www eclipse org legal epl v10(?: html)?
1 {given} (?:eclipse public {lic}|epl) {v}1(?: 0)?{end}
1 {terms} eclipse public {lic} {v}1(?: 0)?{end}
3 (?:eclipse public {lic}|epl) {v}1(?: 0)?{end}
= epl-2 : eclipse epl
0 {spdx} epl 2 0
0 www eclipse org legal epl (?:2 0|v20)(?: html)?
1 {given} (?:eclipse public {lic}|epl) {v}2(?: 0)?{end}
1 {terms} eclipse public {lic} {v}2(?: 0)?{end}
3 (?:eclipse public {lic}|epl) {v}2(?: 0)?{end}
= edl-1 : eclipse
1 {given} eclipse distribution {lic} {v}1 0
3 eclipse distribution {lic} {v}1 0
= cddl-1 : cddl
0 {spdx} cddl 1 0
1 {terms} common development and distribution {lic} cddl(?: version 1 0)?
1 {given} (?:common development and distribution {lic} )?cddl {v}1 0
3 cddl {v}1 0
= cddl-1 : distribution
1 subject to the terms of the common development and distribution {lic}
3 common development and distribution {lic}(?: cddl)?(?: version 1 0)?
= cddl-1.1 : cddl
0 {spdx} cddl 1 1
3 (?:common development and distribution {lic} )?cddl {v}1 1
= cpl-1 : common
0 {spdx} cpl 1 0
1 {given} common public {lic}(?: {v}1 0)?
3 common public {lic} {v}1 0
= eupl-1.1 : eupl
0 {spdx} eupl 1 1
3 (?:european union public {lic} )?eupl {v}1 1
= eupl-1.2 : eupl european
0 {spdx} eupl 1 2
1 {given} (?:european union public {lic} )?eupl(?: {v}1 2)?
1 licensed under the eupl
3 european union public {lic}(?: eupl)?(?: {v}1 2)?
3 eupl {v}1 2
= artistic-1 : artistic
0 {spdx} artistic 1 0(?: perl| cl8)?
3 (?:the )?artistic {lic} {v}1 0
= artistic-2 : artistic
0 {spdx} artistic 2 0
1 {given} artistic {lic} {v}2(?: 0)?{end}
2 the artistic license 2 0 copyright
3 (?:the )?artistic {lic} {v}2(?: 0)?{end}
= artistic : artistic
1 {given} artistic {lic}
1 under the same terms as perl itself
4 (?:the )?artistic {lic}
= perl : perl
1 (?:under|on) the same terms as (?:the )?perl(?: 5)?(?: programming language system)?(?: itself)?
= zlib : zlib
0 {spdx} zlib
0 opensource org licenses zlib
1 {given} zlib(?: libpng)?(?: {lic})?
3 (?:the )?zlib(?: libpng)? {lic}
= zlib : altered
2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software
2 the origin of this software must not be misrepresented you must not claim that you wrote the original software
= libpng : libpng
0 {spdx} libpng 2 0
1 this code is released under the libpng license
3 (?:png reference library|libpng) {lic}
= boost-1 : boost bsl
0 {spdx} bsl 1 0
0 www boost org license 1 0 txt
1 distributed under the boost software license version 1 0
1 {given} boost(?: software)? {lic}(?: {v}1 0)?
3 boost software {lic}(?: {v}1 0)?
= unlicense : unlicense
0 {spdx} unlicense
0 unlicense org
1 {given} unlicense
3 (?:the )?unlicense {lic}
= unlicense : unencumbered
2 this is free and unencumbered software released into the public domain
= wtfpl : wtfpl
0 {spdx} wtfpl
0 www wtfpl net
1 {given} wtfpl(?: version 2)?
4 wtfpl
= wtfpl : fuck
2 do what the fuck you want to public license
= cc0 : cc0 zero
0 {spdx} cc0 1 0
0 creativecommons org publicdomain zero 1 0
1 {given} (?:{cc} )?cc0(?: 1 0)?(?: universal)?
3 creative commons zero(?: v1 0| 1 0)?(?: universal)?
3 cc0(?: 1 0)?(?: universal)?
= cc-by : cc creative creativecommons
0 {spdx} cc by [1-4] [05]
0 creativecommons org licenses by [1-4] [05]
1 {given} {cc} (?:by|attribution){ccv}(?: {lic})?
3 {cc} attribution{ccv} {lic}
4 cc by(?: [1-4] [05])?
4 creative commons attribution
= cc-by-sa : cc creative creativecommons
0 {spdx} cc by sa [1-4] [05]
0 creativecommons org licenses by sa [1-4] [05]
1 {given} {cc} (?:by sa|attribution share ?alike){ccv}(?: {lic})?
3 {cc} (?:by sa|attribution share ?alike){ccv} {lic}
4 cc by sa(?: [1-4] [05])?
4 creative commons attribution share ?alike
= cc-by-nd : cc creative creativecommons
0 {spdx} cc by nd [1-4] [05]
0 creativecommons org licenses by nd [1-4] [05]
1 {given} {cc} (?:by nd|attribution no ?deriv(?:ative)?s){ccv}(?: {lic})?
4 cc by nd(?: [1-4] [05])?
4 creative commons attribution no ?deriv(?:ative)?s
= cc-by-nc : cc creative creativecommons
0 {spdx} cc by nc [1-4] [05]
0 creativecommons org licenses by nc [1-4] [05]
1 {given} {cc} (?:by nc|attribution non ?commercial){ccv}(?: {lic})?
4 cc by nc(?: [1-4] [05])?
4 creative commons attribution non ?commercial
= cc-by-nc-sa : cc creative creativecommons
0 {spdx} cc by nc sa [1-4] [05]
0 creativecommons org licenses by nc sa [1-4] [05]
1 {given} {cc} (?:by nc sa|attribution non ?commercial share ?alike){ccv}(?: {lic})?
4 cc by nc sa(?: [1-4] [05])?
4 creative commons attribution non ?commercial share ?alike
= cc-by-nc-nd : cc creative creativecommons
0 {spdx} cc by nc nd [1-4] [05]
0 creativecommons org licenses by nc nd [1-4] [05]
1 {given} {cc} (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s){ccv}(?: {lic})?
4 cc by nc nd(?: [1-4] [05])?
4 creative commons attribution non ?commercial no ?deriv(?:ative)?s
= ofl-1.1 : ofl sil
0 {spdx} ofl 1 1(?: rfn| no rfn)?
0 scripts sil org ofl
1 {given} sil open font {lic}(?: {v}1 1)?
1 this font software is licensed under the sil open font license version 1 1
3 (?:sil open font {lic}|ofl)(?: {v}1 1)
= odbl : odbl database
0 {spdx} odbl 1 0
0 opendatacommons org licenses odbl
1 {given} (?:open data commons )?open database {lic}(?: odbl)?
3 open database {lic}(?: odbl)?
4 odbl
= odc-by : odc commons
0 {spdx} odc by 1 0
1 {given} open data commons attribution {lic}
3 open data commons attribution {lic}
= pddl : pddl commons
0 {spdx} pddl 1 0
3 (?:open data commons )?public domain dedication and {lic} pddl
3 open data commons public domain dedication and {lic}
= ms-pl : microsoft ms
0 {spdx} ms pl
1 {given} (?:microsoft public {lic}|ms pl)(?: ms pl)?
3 microsoft public {lic}(?: ms pl)?
= ms-rl : microsoft ms
0 {spdx} ms rl
1 {given} (?:microsoft reciprocal {lic}|ms rl)(?: ms rl)?
3 microsoft reciprocal {lic}(?: ms rl)?
= python-2 : python psf
0 {spdx} (?:python|psf) 2 0
1 {given} python software foundation {lic}(?: {v}2)?
1 {given} psf {lic}(?: agreement)?
2 python software foundation license version 2
3 python software foundation {lic}(?: agreement)?
3 psf {lic}(?: agreement)?
= php-3 : php
0 {spdx} php 3 0?1?
1 this source file is subject to version 3 01? of the php license
1 {given} php {lic}(?: {v}3 01?)?
3 (?:the )?php {lic} {v}3 01?
= ruby : ruby
0 {spdx} ruby
1 {given} ruby(?: s)? {lic}
1 (?:under|on) the same terms as ruby(?: itself)?
3 (?:the )?ruby {lic}
= postgresql : postgresql
0 {spdx} postgresql
1 {given} postgresql(?: {lic})?
3 (?:the )?postgresql {lic}
= openssl : openssl
0 {spdx} openssl
1 {given} openssl {lic}
2 this product includes software developed by the openssl project
3 (?:the )?openssl {lic}
= curl : curl
0 {spdx} curl
1 this software is licensed as described in the file copying which you should have received as part of this distribution the terms are also available at https? curl (?:haxx )?se docs copyright html
3 curl {lic}
= vim : vim
0 {spdx} vim
1 {given} vim {lic}
3 (?:the )?vim {lic}
= tcl : tcl
0 {spdx} tcl
3 (?:the )?tcl(?: tk)? {lic}
= ncsa : ncsa
0 {spdx} ncsa
1 {given} university of illinois(?: ncsa)? open source {lic}
3 university of illinois ncsa open source {lic}
= upl-1 : upl universal
0 {spdx} upl 1 0
1 {given} universal permissive {lic}(?: upl)?(?: {v}1 0)?
3 universal permissive {lic}(?: upl)?(?: {v}1 0)?
= osl-3 : osl
0 {spdx} osl 3 0
3 open software {lic}(?: osl)? {v}3 0
1 {given} (?:open software {lic} )?osl {v}3 0
= afl-3 : afl academic
0 {spdx} afl 3 0
1 licensed under the academic free license version 3 0
3 academic free {lic}(?: afl)? {v}3 0
= sspl-1 : sspl server
0 {spdx} sspl 1 0
1 {given} server side public {lic}(?: {v}1)?
3 server side public {lic}(?: sspl)?(?: {v}1)?
= busl-1.1 : busl business
0 {spdx} busl 1 1
1 {given} business source {lic}(?: {v}1 1)?
3 business source {lic}(?: {v}1 1)?
= elastic-2 : elastic
0 {spdx} elastic 2 0
1 {given} elastic {lic}(?: {v}2(?: 0)?)?
3 elastic {lic} {v}2(?: 0)?{end}
= cecill-2.1 : cecill
0 {spdx} cecill 2 [01]
1 governed by the cecill {lic} under french law
3 cecill(?: free software)? {lic}(?: {v}2 [01])?
= mulan-psl-2 : mulan mulanpsl2
0 {spdx} mulanpsl 2 0
1 {given} mulan psl v2
3 mulan (?:psl|permissive software {lic}) {v}2
= qpl-1 : qpl trolltech
0 {spdx} qpl 1 0
1 {terms} q public {lic}(?: version 1 0)? (?:qpl|as defined by trolltech)
3 q public {lic} qpl
= wxwindows : wxwindows
0 {spdx} wxwindows
1 {given} wxwindows(?: library)? {lic}
3 wxwindows(?: library)? {lic}
= openrail : rail openrail
0 license (?:creativeml )?openrail(?: m)?
1 {given} (?:creativeml |bigscience )?(?:open ?)?rail(?: m)? {lic}
3 creativeml open rail m {lic}
3 bigscience (?:bloom )?rail {lic}
= llama-community : llama
1 {given} llama(?: [23])?(?: [123])? community {lic}(?: agreement)?
3 llama(?: [23])?(?: [123])? community {lic}(?: agreement)?
= public-domain : domain
1 (?:this|the) (?:work|file|code|software|program) is (?:hereby )?(?:placed in|released into|dedicated to|in) the public domain
1 (?:i|we) (?:hereby )?(?:place|release|dedicate) (?:this|the) (?:work|file|code|software|program) (?:in|into|to) the public domain
2 no copyright is claimed and (?:this|the) (?:work|file|code|software) is in the public domain
3 (?:released into|dedicated to|placed in) the public domain
4 in the public domain
= proprietary : proprietary confidential
1 {given} (?:a |our )?proprietary {lic}
2 (?:unauthorized|unauthorised) copying of this file via any medium is strictly prohibited proprietary and confidential
3 proprietary and confidential
4 proprietary {lic}
= proprietary : commercial
1 {given} (?:a |our )?commercial {lic}
4 commercial {lic}
= all-rights-reserved : reserved
5 all rights reserved
5 some rights reserved
"""
