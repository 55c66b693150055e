"""Fixed values of the license scan: notices and passages of the usual licenses, by label.

``{}`` in a label stands for the version that the text names. Notices are the ways to lead in times the names of a license; passages are
sentences of the licenses' own texts, the beginning and others from further on.
"""

from __future__ import annotations

LEADS = ("licensed under the", "released under the", "distributed under the", "available under the", "under the terms of the", "covered by the")
BARE_LEADS = ("licensed under", "released under", "distributed under", "available under", "under the terms of", "covered by")

#: The names of each license after a lead. Every number is one word to the scan, so 2.0 stands for 1.1 and 2 for 3 as well.
NAMES = {
    "MIT": ["MIT License", "MIT open source license"],
    "Apache-{}": [
        "Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache License", "Apache Software License",
    ],
    "ISC": ["ISC License"],
    "BSD": ["BSD License", "BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Simplified BSD License"],
    "MPL-{}": ["Mozilla Public License", "Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0"],
    "EPL-{}": ["Eclipse Public License", "Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "Unlicense": ["Unlicense license"],
    "Zlib": ["zlib License"],
    "BSL-{}": ["Boost Software License", "Boost Software License, Version 1.0"],
}
for _label, _family in {"GPL": "General", "LGPL": "Lesser General", "AGPL": "Affero General"}.items():
    _name = f"GNU {_family} Public License"
    NAMES[f"{_label}-{{}}"] = [
        _name, f"{_name}, version 3", f"{_name} version 3.0", f"{_name} v3", f"{_name} v3.0", f"{_name} 3.0", f"GNU {_label} version 3",
        f"GNU {_label} version 3.0", f"GNU {_label} v3", f"GNU {_label} v3.0", f"{_label} version 3", f"{_label} version 3.0", f"{_label} v3.0",
        f"{_label} v3", f"{_label} 3.0", f"{_label}-3 license", f"{_label} License",
    ]

#: The parts of a Creative Commons license: label, short name, long name.
CREATIVE_COMMONS = {
    "CC-BY-{}": ("CC BY", "Attribution"),
    "CC-BY-SA-{}": ("CC BY-SA", "Attribution-ShareAlike"),
    "CC-BY-ND-{}": ("CC BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-{}": ("CC BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-SA-{}": ("CC BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-{}": ("CC BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
}

WARRANTY = "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE"
_GNU = (
    "{what} is free software: you can redistribute it and/or modify it under the terms of the GNU {family} Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
)

PASSAGES = {
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        f'THE SOFTWARE IS PROVIDED "AS IS", {WARRANTY} AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, '
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE",
    ],
    "Apache-{}": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, "
        "prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ],
    "GPL-{}": [
        _GNU.format(what="This program", family="General"),
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ],
    "LGPL-{}": [
        _GNU.format(what="This library", family="Lesser General"),
        "You should have received a copy of the GNU Lesser General Public License along with this library",
    ],
    "AGPL-{}": [
        _GNU.format(what="This program", family="Affero General"),
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation "
        "with the community in the case of network server software.",
    ],
    "MPL-{}": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ],
    "EPL-{}": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for "
        "any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions",
    ],
    "BSL-{}": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered "
        "by this license",
    ],
}


def _usual() -> dict[str, list[str]]:
    out = {f"{label} notice": [f"{lead} {name}" for lead in LEADS for name in names] for label, names in NAMES.items()}
    for label, (short, long) in CREATIVE_COMMONS.items():
        forms = [f"{short} 4.0", f"Creative Commons {long} 4.0", f"Creative Commons {long} License"]
        forms += [f"Creative Commons {long} 4.0 {scope} License" for scope in ("International", "Unported", "Generic")]
        out[f"{label} notice"] = [f"{lead}{article} {form}" for lead in BARE_LEADS for article in ("", " a", " the") for form in forms]
    # a short name is a notice only if it has the words that the scan needs
    return {name: [t for t in texts if len(t.replace("-", " ").replace(".", " ").split()) >= 5] for name, texts in out.items()} | PASSAGES


USUAL = _usual()
