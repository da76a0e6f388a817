"""Licence notices and texts to look for, and the words of them that tell versions and names apart."""

from pathlib import Path

# Full texts of the longer licences, as published, one file each.
FULL_TEXTS = {
    f"{file.stem} full text": file.read_text(encoding="utf-8") for file in sorted((Path(__file__).parent / "license_data").glob("*.txt"))
}

# The usual wording of notices and grants, without names and years.
_NOTICES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": """
        This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.""",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    "ISC": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MIT line": "Released under the MIT License.",
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software.""",
}

_MIT_WARRANTY = """
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
        AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE."""
_BSD_2 = """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""
_BSD_3 = """
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission."""
_BSD_4 = """
        3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
        This product includes software developed by the organization. 4. Neither the name of the copyright holder nor the names
        of its contributors may be used to endorse or promote products derived from this software without specific prior written
        permission."""
_BSD_WARRANTY = """
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
        IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_TEXTS = {
    "0BSD full text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
    + _ISC_WARRANTY,
    "BSD-2-Clause full text": _BSD_2 + _BSD_WARRANTY,
    "BSD-3-Clause full text": _BSD_2 + _BSD_3 + _BSD_WARRANTY,
    "BSD-4-Clause full text": _BSD_2 + _BSD_4 + _BSD_WARRANTY,
    "ISC full text": _NOTICES["ISC"] + _ISC_WARRANTY,
    "MIT full text": _NOTICES["MIT"] + _MIT_WARRANTY,
    "Unlicense full text": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of
        this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for
        the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an
        overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."""
    + _MIT_WARRANTY.replace("AUTHORS OR\n        COPYRIGHT HOLDERS", "AUTHORS"),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib full text": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "MPL-2.0": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "CC0-1.0": """
        To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.""",
}
# Words in a row that must stand in the text as they are.
_OBLIGATORY = {
    "Apache-2.0 line": ["apache license version 2 0"],
    "Apache-2.0": ["apache license version 2 0"],
    "ISC": ["provided that the above copyright notice"],
    "MIT": ["the above copyright notice"],
    "MIT line": ["mit license"],
    "GPL-3.0-or-later": ["the gnu general public license", "version 3 of the license", "any later version"],
    "ISC full text": ["provided that the above copyright notice"],
    "MIT full text": ["the above copyright notice"],
    "BSD-3-Clause full text": ["endorse or promote products"],
    "BSD-4-Clause full text": ["advertising materials", "endorse or promote products"],
    "Unlicense": ["unencumbered software released into the public domain"],
    "MPL-2.0": ["mozilla public license v 2 0"],
    "CC0-1.0": ["waived all copyright"],
    "0BSD full text": ["is hereby granted the software is provided"],
    "BSD-2-Clause full text": ["redistributions in binary form must reproduce"],
    "Unlicense full text": ["unencumbered software released into the public domain"],
    "Zlib full text": ["the origin of this software must not be misrepresented"],
    # title, version and date
    "Apache-2.0 full text": ["apache license version 2 0 january 2004"],
    "CC0-1.0 full text": ["cc0 1 0 universal"],
    "GPL-1.0 full text": ["gnu general public license version 1 february 1989"],
    "GPL-2.0 full text": ["gnu general public license version 2 june 1991"],
    "GPL-3.0 full text": ["gnu general public license version 3 29 june 2007"],
    "LGPL-2.0 full text": ["gnu library general public license version 2 june 1991"],
    "LGPL-2.1 full text": ["gnu lesser general public license version 2 1 february 1999"],
    "LGPL-3.0 full text": ["gnu lesser general public license version 3 29 june 2007"],
    "MPL-1.1 full text": ["mozilla public license version 1 1"],
    "MPL-2.0 full text": ["mozilla public license version 2 0"],
}


def _add(name: str, text: str, *obligatory: str) -> None:
    """A further wording, under a name of its own."""
    key, number = name, 2
    while key in _NOTICES or key in _TEXTS:
        key, number = f"{name} {number}", number + 1
    _NOTICES[key], _OBLIGATORY[key] = text, list(obligatory)


def _add_gnu() -> None:
    kinds = {"GPL": ("General", ("1.0", "2.0", "3.0")), "LGPL": ("Lesser General", ("2.1", "3.0")), "AGPL": ("Affero General", ("3.0",))}
    kinds["LGPL-2.0"] = ("Library General", ("2.0",))
    for short, (kind, versions) in kinds.items():
        for version in versions:
            name, said = f"{short.split('-')[0]}-{version}", version.removesuffix(".0")
            title, number = f"gnu {kind} Public License".lower(), f"version {said}".replace(".", " ")
            for verb in ("This work is licensed under the", "Licensed under the", "Released under the"):
                line = f"{verb} GNU {kind} Public License, version {said}."
                if line in _NOTICES.values():
                    continue
                _add(f"{name} line", line, f"{title} {number}")
            for verb in ("Licensed under the", "Released under the"):
                _add(f"{name} line", f"{verb} GNU {kind} Public License v{said}.", f"{title} v{said}".replace(".", " "))
            terms = f"""
        This program is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} Public License
        as published by the Free Software Foundation, """
            rest = f"""
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details."""
            named = [title, f"{number} of the license"]
            _add(f"{name}-only", f"{terms}version {said} of the License.{rest}", *named)
            if f"{name}-or-later" not in _NOTICES:
                later = f"either version {said} of the License, or (at your option) any later version."
                _add(f"{name}-or-later", terms + later + rest, *named, "any later version")
    _OBLIGATORY["GPL-3.0 line"] = ["gnu general public license version 3"]


def _add_creative_commons() -> None:
    said = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version in ("2.0", "2.5", "3.0", "4.0"):
            name = f"CC-{kind}-{version}"
            words = f"{kind} {version}".replace("-", " ").replace(".", " ").lower()
            for verb in ("Licensed under", "This work is licensed under", "Released under"):
                line = f"{verb} CC {kind} {version}."
                if line not in _NOTICES.values():
                    _add(f"{name} line", line, f"cc {words}")
            title = "-".join(said[k] for k in kind.split("-"))
            words = f"{title} {version}".replace("-", " ").replace(".", " ").lower()
            place = {"3.0": " Unported", "4.0": " International"}.get(version, "")
            line = f"This work is licensed under a Creative Commons {title} {version}{place} License."
            if name not in _NOTICES:
                _add(name, line, f"creative commons {words}")
    _OBLIGATORY["CC-BY-NC-4.0 line"] = ["cc by nc 4 0"]
    _OBLIGATORY["CC-BY-SA-4.0"] = ["creative commons attribution sharealike 4 0"]


def _add_names() -> None:
    names = {
        "MIT": ["MIT License"],
        "ISC": ["ISC License"],
        "BSD": ["BSD License"],
        "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License"],
        "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"],
        "Apache-1.1": ["Apache License, Version 1.1", "Apache Software License, Version 1.1"],
        "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
        "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1"],
        "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
        "Unlicense": ["Unlicense"],
        "Zlib": ["zlib License"],
        "BSL-1.0": ["Boost Software License, Version 1.0"],
        "EPL-1.0": ["Eclipse Public License, version 1.0", "Eclipse Public License v1.0"],
        "EPL-2.0": ["Eclipse Public License, version 2.0", "Eclipse Public License v2.0"],
    }
    for name, said in names.items():
        for title in said:
            for verb in ("Released under the", "Licensed under the"):
                line = f"{verb} {title}."
                if line not in _NOTICES.values():
                    plain = "".join(c if c.isalnum() else " " for c in title.lower())
                    _add(f"{name} line", line, f"the {plain}")
    ids = [n for n in names if n not in ("BSD", "Apache-1.1")] + ["MIT-0", "0BSD", "CC0-1.0", "Apache-1.1", "BSD-4-Clause", "BSD-3-Clause-Clear"]
    for gnu in ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
        ids += [gnu, f"{gnu}-only", f"{gnu}-or-later"]
    ids += [f"CC-{k}-{v}" for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("2.0", "2.5", "3.0", "4.0")]
    for name in ids:
        plain = name.lower().replace("-", " ").replace(".", " ")
        _add(f"{name} identifier", f"SPDX-License-Identifier: {name}", f"spdx license identifier {plain}")


_add_gnu()
_add_creative_commons()
_add_names()

TEMPLATES = {**_NOTICES, **_TEXTS, **FULL_TEXTS}
OBLIGATORY = {name: tuple(phrases) for name, phrases in _OBLIGATORY.items()}
