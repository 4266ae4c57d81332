"""Held-out wordings: notices that no template repeats, and paragraphs that only sound like one."""

import pytest

from vocabloom.llm import licences

PLAIN = ["the river runs over the stone and the software of the town", "a cloud of green is distributed under the sky", "the general terms of this work", "public roads and free copies"] * 30
WORDINGS = {
    "mit": ["This software is released under the terms of the MIT License", "The project is licensed under the MIT license, see LICENSE", "# SPDX-License-Identifier: MIT"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0 by the project authors", "This file is licensed under the Apache License, Version 2.0.", "// SPDX-License-Identifier: Apache-2.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 2.", "you should have received a copy of the GNU General Public License along with this library"],
    "lgpl": ["This file is licensed under the GNU Lesser General Public License, version 3."],
    "agpl": ["This server is licensed under the GNU Affero General Public License, version 3"],
    "bsd": ["Redistribution and use in source and binary forms, with or without changes, are permitted provided that the following conditions are met:"],
    "isc": ["Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above notice appears in all copies."],
    "zlib": ["Permission is granted to anyone to use this library for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to"],
    "unlicense": ["This is free and unencumbered code released into the public domain."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."],
    "epl": ["This program and the accompanying files are made available under the terms of the Eclipse Public License v2"],
    "cc-by": ["Text is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Text is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["Images are licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
}
OTHERS = [
    "The public was licensed to fish in the river under general terms", "permission was granted to anyone who asked", "free software and open standards were discussed",
    "MIT opened a new laboratory in version 2 of its plan", "The Apache helicopter flew over", "a general public of readers", "all copies of the book were sold", "She used the tool for any purpose",
]


@pytest.fixture(scope="module")
def model():
    return licences.train(PLAIN)


def test_recall_by_family(model):
    missed = [(f, w) for f, texts in WORDINGS.items() for w in texts if f not in [x[2] for x in licences.find_licences(model, w)]]
    wrong = [(f, w, x[2]) for f, texts in WORDINGS.items() for w in texts for x in licences.find_licences(model, w) if x[2] != f]
    assert not missed and not wrong


def test_other_paragraphs_have_none(model):
    assert [(t, f) for t in OTHERS for f in licences.find_licences(model, t)] == []
