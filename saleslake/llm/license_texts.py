"""Known licence texts and the forms of licence notices.  Copyright lines are left out, as matching drops them."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

ZERO_BSD = ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""

BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

TEXTS = [
    ("MIT", MIT),
    ("MIT", "MIT License\n" + MIT),
    ("MIT", "The MIT License (MIT)\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n" + ISC),
    ("0BSD", ZERO_BSD),
    ("Zlib", ZLIB),
    ("BSD-2-Clause", f"{BSD_HEAD}\n{BSD_TAIL}"),
    ("BSD-3-Clause", f"{BSD_HEAD}\n{BSD_THIRD}\n{BSD_TAIL}"),
]

#: Licence id, SHA-256 and length of the canonical form of further whole texts and standard headers.
DIGESTS = [
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543", 9886),  # whole
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40", 8870),  # without appendix
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f", 8842),  # without appendix and end line
    ("Apache-2.0", "7a46cf4a5d56898d746584f4fe57bdf571d600a8f39d21063431d88929f803c7", 501),  # header
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", 6692),  # whole
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", 17117),  # whole
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34", 14483),  # without appendix
    ("GPL-2.0", "3606e919f92e4862a5628788f284c07f5a0ca41b819f88414d7e825dca4facc4", 657),  # header
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a", 33406),  # whole
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636", 30968),  # without appendix
    ("GPL-3.0", "b1165b3a9c3ac2638585a8adb6e0c10814b7d97627160747134355b2690ff5af", 589),  # header
    ("LGPL-3.0", "d55f73055e58bb45ba8eca26bfe5f3b91426e2cfede6a66456ef0a7b34ed1ae9", 610),  # header
    ("AGPL-3.0", "c0ad612dff09f3a46d284cd6326222f812128e76a7a058c916379ff339c394ba", 610),  # header
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", 7104),  # whole
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d", 14342),  # whole
    ("MPL-2.0", "acb0bece3dc447740b87a4db23e0d425157552e4a33f273241a94444c2368900", 184),  # header
]

#: Licence id, its name in notices.
NAMES = [
    ("Apache-2.0", "the Apache License, Version 2.0"),
    ("MIT", "the MIT License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("GPL-2.0", "the GNU General Public License, version 2"),
    ("GPL-3.0", "the GNU General Public License, version 3"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "the GNU Affero General Public License, version 3"),
    ("CC0-1.0", "CC0 1.0"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
]

NOTICES = ["Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "This software is licensed under {}."]

#: Equivalent spellings, each to the form that is hashed.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"), ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("favour", "favor"), ("behaviour", "behavior"),
    ("https:", "http:"), ("copyright owner", "copyright holder"), ("&", " and "),
]
