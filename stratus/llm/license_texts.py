"""Texts of known licenses and one-line notices (fixed values: public texts, as published).

Long texts are files of ``license_files``, named by license.
"""

import re
from importlib import resources

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""

_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

"""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

LICENSES = {
    "MIT": _MIT,
    "MIT (titled)": "MIT License\n\n" + _MIT,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_DISCLAIMER,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _ISC_DISCLAIMER,
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + _BSD_THIRD + _BSD_TAIL,
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.
""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>
""",
}

#: (whole line, license)
NOTICES = (
    ("Released under the MIT License.", "MIT"),
    ("Licensed under the MIT License.", "MIT"),
    ("This project is licensed under the MIT License.", "MIT"),
    ("SPDX-License-Identifier: MIT", "MIT"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Released under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");", "Apache-2.0"),
    ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only"),
    ("Released under the GNU General Public License, version 3.", "GPL-3.0-only"),
    ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0-only"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("SPDX-License-Identifier: CC-BY-4.0", "CC-BY-4.0"),
)

#: Lines that stand over the text of a license, besides none and "MIT License" (above).
TITLES = {
    "MIT": ("The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD 0-Clause License", "0BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License",
                     "Simplified BSD License", "FreeBSD License", "BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License",
                     "New BSD License", "The New BSD License", "Modified BSD License", "Revised BSD License", "BSD License", "BSD-3-Clause"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
#: Addresses of the Free Software Foundation in editions of its licenses.
_ADDRESS = re.compile(r"51\s+Franklin\s+St(?:reet)?,\s+Fifth\s+Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA")
_ADDRESSES = ("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301, USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
              "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA",
              "675 Mass Ave, Cambridge, MA 02139, USA")
_TERMS_END = re.compile(r"^.*END OF TERMS AND CONDITIONS.*$", re.MULTILINE)


def titled() -> list[tuple[str, str]]:
    """(license, entire text) under each of its titles."""
    return [(i, f"{title}\n\n{LICENSES[i]}") for i, titles in TITLES.items() for title in titles]


def files() -> list[tuple[str, str]]:
    """(license, entire text) of the license files."""
    folder = resources.files("stratus.llm").joinpath("license_files")
    return [(f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in sorted(folder.iterdir(), key=lambda f: f.name)]


def editions() -> list[tuple[str, str]]:
    """(license, entire text): under each of its titles; long texts also without
    what follows the terms (how to apply them) and with other addresses."""
    out = titled()
    for name, text in files():
        forms = [text] + [text[:at] for m in _TERMS_END.finditer(text) for at in m.span()]
        forms += [_ADDRESS.sub(address, form) for form in forms for address in _ADDRESSES if _ADDRESS.search(form)]
        out += [(name, form) for form in forms]
    return out
