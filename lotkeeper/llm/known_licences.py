"""Known licence texts and notices, and spellings that count as equal. The words of the licences."""

from __future__ import annotations

import pkgutil
import re

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_0BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")

_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_2 = f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

{_BSD_END}"""

_BSD_3 = _BSD_2.replace(_BSD_END, f"""3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

{_BSD_END}""")

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: (name, text): whole licences, with and without their titles, and one-line notices; more of both is added below.
KNOWN: list[tuple[str, str]] = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("0BSD", _0BSD),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_2),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_3),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
]

#: Long licences, a file each, as published and with a line for every paragraph.
for _name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"):
    _text = pkgutil.get_data(__package__, f"licence_texts/{_name}.txt").decode("utf-8").replace("\r\n", "\n")
    KNOWN += [(_name, _text), (_name, re.sub(r"(?<!\n)[ \t]*\n(?![ \t]*\n)[ \t]*", " ", _text))]

#: What notices call a licence; "BSD" is one that names no clauses.
TITLES: list[tuple[str, list[str]]] = [
    ("MIT", ["the MIT License", "the MIT License (MIT)", "MIT"]),
    ("ISC", ["the ISC License", "ISC"]),
    ("0BSD", ["the BSD Zero Clause License", "the Zero-Clause BSD License", "0BSD"]),
    ("BSD", ["the BSD License", "a BSD-style License", "BSD"]),
    ("BSD-2-Clause", ["the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License", "BSD-2-Clause"]),
    ("BSD-3-Clause", ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License",
                      "BSD-3-Clause"]),
    ("Zlib", ["the zlib License", "the zlib/libpng License", "zlib"]),
    ("Apache-2.0", ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache 2.0"]),
    ("MPL-2.0", ["the Mozilla Public License, Version 2.0", "the Mozilla Public License 2.0", "the MPL 2.0", "MPL 2.0"]),
    ("CC0-1.0", ["CC0 1.0", "CC0 1.0 Universal", "the Creative Commons CC0 1.0 Universal License"]),
    ("Unlicense", ["the Unlicense", "Unlicense"]),
]
for _name, _long, _versions in (("GPL", "GNU General Public License", "23"), ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
                                ("AGPL", "GNU Affero General Public License", "3")):
    for _v in _versions:
        TITLES.append((f"{_name}-{_v}" if "." in _v else f"{_name}-{_v}.0", [
            x + end for x in (f"the {_long}, version {_v}", f"the {_long} v{_v}", f"the {_long} {_v}", f"the GNU {_name}v{_v}",
                              f"the {_name}v{_v}", f"the {_name} v{_v}", f"the {_name} {_v}", f"the {_name} version {_v}", f"{_name}v{_v}")
            for end in ("", ".0")[:1 + ("." not in _v)]]))
for _kind, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                      ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    TITLES.append((f"CC-{_kind}-4.0", [
        x for own in (f"CC {_kind} 4.0", f"Creative Commons {_words} 4.0", f"Creative Commons {_words} 4.0 International")
        for x in (own, f"the {own} License", f"a {own} License")]))

#: Every wording of a notice for every title.
KNOWN += [(_name, f"{_lead} {_title}.") for _name, _titles in TITLES for _title in _titles for _lead in [
    f"{_what}{_verb} under" for _what in ("", "This work is ", "This software is ", "This project is ", "This file is ", "This document is ")
    for _verb in ("licensed", "released", "distributed", "made available")]]
KNOWN += [(_name, f"SPDX-License-Identifier: {_id}") for _name, _ in TITLES if _name != "BSD" for _id in (
    [_name, f"{_name}-only", f"{_name}-or-later"] if "GPL" in _name else [_name])]

#: Equivalent words, over text in lower case without punctuation: (variant, usual).
SPELLINGS: list[tuple[str, str]] = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("e mail", "email"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("https", "http"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("offence", "offense"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("recognised", "recognized"),
    ("sub license", "sublicense"),
    ("whilst", "while"),
    ("wilful", "willful"),
]
