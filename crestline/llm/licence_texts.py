"""Texts of public licences that licence scans compare with.

All strings here are fixed values: notices, titles and headers as the licences' stewards give them, and the whole
texts of the short licences, without names of holders.
"""

#: The licence of a text that grants nothing.
RESERVED = "All-Rights-Reserved"

#: Short notices, titles and headers, by SPDX identifier.
NOTICES = {
    RESERVED: ["All rights reserved.", "Copyright. All rights reserved."],
    "AGPL-3.0": [
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 2-Clause License."],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Creative Commons Attribution 4.0 International Public License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Licensed under CC0 1.0.", "Creative Commons CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "EPL-2.0": ["Eclipse Public License - v 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"],
    "GPL-2.0": [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": ["ISC License", "Licensed under the ISC License."],
    "LGPL-2.1": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": ["Released under the MIT License.", "MIT License", "Licensed under the MIT License."],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0",
        "This source code form is subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": ["zlib License"],
}

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
"""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""

#: Whole texts of short licences, and their granting paragraphs by themselves.
TEXTS = {
    "BSD-2-Clause": [_BSD_START + _BSD_END],
    "BSD-3-Clause": [_BSD_START + _BSD_NAMES + _BSD_END],
    "BSL-1.0": ["""Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
"""],
    "ISC": [_ISC_GRANT, _ISC_GRANT + """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""],
    "MIT": [_MIT_GRANT, _MIT_GRANT + """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""],
    "Unlicense": ["""Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
"""],
    "Zlib": ["""This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
"""],
}


def templates() -> list[tuple[str, str]]:
    """(licence, text) of all templates: notices, texts, and the identifier line of each licence."""
    tags = [(k, f"SPDX-License-Identifier: {k}{end}") for k in NOTICES if k != RESERVED for end in (("", "-only", "-or-later") if "GPL" in k else ("",))]
    return [*((k, t) for table in (NOTICES, TEXTS) for k, ts in table.items() for t in ts), *tags]
