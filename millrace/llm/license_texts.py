"""Notices of licence families and texts that only sound like them; the classifier is trained on these."""

from __future__ import annotations

# Customary notices of public licences.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License, see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under the Creative Commons Attribution License CC BY 3.0.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0, for non-commercial use only.",
    ],
    "public-domain": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work, CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "This work is in the public domain.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 the authors. All rights reserved.",
        "No part of this publication may be reproduced or distributed in any form without the prior written permission of the publisher; copyright and all rights reserved.",
    ],
}

UNRELATED = [
    "Drivers must carry a valid licence and proof of insurance at all times.",
    "The restaurant applied for a licence to sell beer and wine last spring.",
    "He lost his driving licence after the accident on the motorway.",
    "A fishing licence is required on the river between March and October.",
    "The pilot was licensed to fly small aircraft over the valley.",
    "The warranty on the washing machine covers parts and labour for two years.",
    "She asked for permission to leave the room before the end of the lesson.",
    "Permission to build the new house was refused by the council.",
    "The court ruled that the copyright in the photographs belonged to the newspaper.",
    "Copyright law differs between countries and changes over time.",
    "The company plans to redistribute profits among its employees.",
    "The software is sold under a license that each customer negotiates with the vendor.",
    "Use of the service is subject to the terms of a separate agreement, see the license terms of the vendor.",
    "This dataset has a custom license; contact the maintainers before use.",
    "The version of the program used in the study was released under an unnamed license.",
    "Artists may license their songs to film studios for a fee.",
    "The Apache people lived in the southwest and traded with their neighbours.",
    "Students at MIT released a robot that plays table tennis.",
    "The gnu is a large antelope of the African plains.",
    "The museum holds maps that are long out of print and in poor condition.",
    "Free parking is available to all persons visiting the library.",
    "The new law grants farmers the right to use water from the lake.",
]
