"""Public license notices, as texts to look for. Replace or extend them as a parameter."""

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software."
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_3 = _BSD_2 + (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(what: str, name: str, version: str, mark: str = ";", of: str = " of the License") -> str:
    return (
        f"This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU "
        f"{name} as published by the Free Software Foundation{';' if mark == ';' else ','} either version {version}{of}, or "
        "(at your option) any later version."
    )


_GPL, _LESSER, _AFFERO = "General Public License", "Lesser General Public License", "Affero General Public License"
_GNU_LINES = {"GPL-2.0": (_GPL, "2"), "LGPL-2.1": (_LESSER, "2.1"), "LGPL-3.0": (_LESSER, "3"), "AGPL-3.0": (_AFFERO, "3")}
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"4.0": "4.0 International", "3.0": "3.0 Unported"}

# Name -> notice. Short names as in the SPDX list; "-line" marks a one-line reference,
# "-text" a whole licence, "-warranty" its disclaimer alone. Close relatives stand side by side, so that the
# better covered one wins.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT-line": "Released under the MIT License.",
    "MIT": _MIT_GRANT,
    "MIT-warranty": _MIT_WARRANTY,
    "MIT-text": f"{_MIT_GRANT} {_MIT_WARRANTY}",
    "BSD-line": "Released under the BSD License.",
    "ISC-line": "Released under the ISC License.",
    "BSD-2-Clause": _BSD_2,
    "BSD-3-Clause": _BSD_3,
    "BSD-warranty": _BSD_WARRANTY,
    "BSD-2-Clause-text": f"{_BSD_2} {_BSD_WARRANTY}",
    "BSD-3-Clause-text": f"{_BSD_3} {_BSD_WARRANTY}",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    **{f"{k}-line": f"This work is licensed under the GNU {name}, version {v}." for k, (name, v) in _GNU_LINES.items()},
    "GPL-1.0": _gnu("program", _GPL, "1", of=""),
    "GPL-2.0": _gnu("program", _GPL, "2"),
    "GPL-3.0": _gnu("program", _GPL, "3", ":"),
    "LGPL-2.0": _gnu("library", "Library General Public License", "2"),
    "LGPL-2.1": _gnu("library", _LESSER, "2.1"),
    "LGPL-3.0": _gnu("program", _LESSER, "3", ":"),
    "AGPL-3.0": _gnu("program", _AFFERO, "3", ":"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    **{f"CC-{k}-{v}-line": f"Licensed under CC {k} {v}." for k in _CC for v in _CC_VERSIONS},
    **{
        f"CC-{k}-{v}": f"This work is licensed under a Creative Commons {kind} {long} License."
        for k, kind in _CC.items()
        for v, long in _CC_VERSIONS.items()
    },
}
