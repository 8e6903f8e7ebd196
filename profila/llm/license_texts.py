"""Texts, notices and short lines of common licenses, by SPDX id.

Texts are given whole where they are short; the long licenses (Apache, GPL,
LGPL, AGPL, MPL, Creative Commons) by the notices that their own texts tell users
to put into files.  Lines follow a few rules over the names below.
"""

from __future__ import annotations

_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. ")
_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission. ")
_ISC_END = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
            "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
            "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
            "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")

TEXTS = {
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "BSD-2-Clause text": _BSD + _DISCLAIMER,
    "BSD-3-Clause text": _BSD + _THIRD + _DISCLAIMER,
    "ISC text": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
                 + _ISC_END),
    "0BSD text": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted. " + _ISC_END),
    "Unlicense text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
        "or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend "
        "this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        "software under copyright law."),
    "Zlib text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions"),
    "Apache-2.0 full notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "MPL-2.0 notice": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                       "MPL was not distributed with this file, You can obtain one at"),
    "CC0-1.0 notice": ("To the extent possible under law, the author has waived all copyright and related or neighboring "
                       "rights to this work"),
}


def _gnu(name: str, what: str, version: str, later: bool) -> str:
    either = f"either version {version} of the License, or (at your option) any later version" if later else f"version {version} of the License"
    return (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
            f"published by the Free Software Foundation, {either}. This {what} is distributed in the hope that it will be "
            "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
            f"PARTICULAR PURPOSE. See the GNU {name} for more details.")


_GNU = {("GPL", "General Public License", "program"): ("2.0", "3.0"),
        ("LGPL", "Lesser General Public License", "library"): ("2.1", "3.0"),
        ("AGPL", "Affero General Public License", "program"): ("3.0",)}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: licenses that lines name by a title of their own
_TITLES = {"MIT": "MIT License", "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
           "Apache-2.0": "Apache License 2.0", "MPL-2.0": "Mozilla Public License 2.0", "Unlicense": "Unlicense",
           "Zlib": "zlib License", "BSL-1.0": "Boost Software License 1.0", "EPL-2.0": "Eclipse Public License 2.0"}


def templates() -> dict[str, str]:
    """Every text, notice and line by its name."""
    out, ids = dict(TEXTS), [*_TITLES, "0BSD", "CC0-1.0"]
    for (code, name, what), versions in _GNU.items():
        for v in versions:
            short = v.removesuffix(".0")
            out[f"{code}-{v}-or-later notice"] = _gnu(name, what, short, True)
            out[f"{code}-{v}-only notice"] = _gnu(name, what, short, False)
            out[f"{code}-{v} line"] = f"Licensed under the GNU {name} v{v}"
            out[f"{code}-{v} name"] = f"Licensed under the GNU {name}, version {short}"
            ids += [f"{code}-{v}-only", f"{code}-{v}-or-later"]
    for code, name in _CC.items():
        for version, place in (("4.0", "International"), ("3.0", "Unported")):
            out[f"CC-{code}-{version}"] = f"This work is licensed under a Creative Commons {name} {version} {place} License"
            out[f"CC-{code}-{version} line"] = f"Licensed under CC {code} {version}"
            ids.append(f"CC-{code}-{version}")
    for spdx, title in _TITLES.items():
        out[f"{spdx} licensed"], out[f"{spdx} released"] = f"Licensed under the {title}", f"Released under the {title}"
    out |= {f"{spdx} identifier": f"SPDX-License-Identifier: {spdx}" for spdx in ids}
    return out
