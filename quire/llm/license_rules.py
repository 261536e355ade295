"""Signature rules of license notices, most of them made from tables of names and versions.

Patterns see lower-case words joined by single blanks. ``(WORDS n)`` stands for
up to n words of any kind.
"""

from __future__ import annotations

from dataclasses import dataclass

# Priorities: a whole grant, a license named with its version, a bare name or tag.
GRANT, NAMED, TAG = 3, 2, 1
CONFIDENCE = {GRANT: 0.95, NAMED: 0.8, TAG: 0.5}


@dataclass(frozen=True)
class Signature:
    label: str
    keyword: str
    pattern: str
    priority: int


def gap(n: int) -> str:
    return f"(?:[^ ]+ ){{0,{n}}}"


# License families by label stem, keyword, name pattern and known versions.
VERSIONED = [
    ("agpl", "affero", "(?:gnu )?affero general public licen[cs]e", ("1", "3")),
    ("gpl", "general public", "(?:gnu )?general public licen[cs]e", ("1", "2", "3")),
    ("lgpl", "lesser general", "(?:gnu )?lesser general public licen[cs]e", ("2 1", "3")),
    ("lgpl", "library general", "(?:gnu )?library general public licen[cs]e", ("2",)),
    ("gfdl", "documentation licen", "(?:gnu )?free documentation licen[cs]e", ("1 1", "1 2", "1 3")),
    ("apache", "apache", "apache(?: software)? licen[cs]e", ("1", "1 1", "2")),
    ("mpl", "mozilla public", "mozilla public licen[cs]e", ("1", "1 1", "2")),
    ("epl", "eclipse public", "eclipse public licen[cs]e", ("1", "2")),
    ("eupl", "european union public", "european union public licen[cs]e", ("1", "1 1", "1 2")),
    ("cddl", "common development", "common development and distribution licen[cs]e", ("1", "1 1")),
    ("cpl", "common public", "common public licen[cs]e", ("1",)),
    ("ipl", "ibm public", "ibm public licen[cs]e", ("1",)),
    ("osl", "open software licen", "open software licen[cs]e", ("1", "1 1", "2", "2 1", "3")),
    ("afl", "academic free", "academic free licen[cs]e", ("1 1", "1 2", "2", "2 1", "3")),
    ("artistic", "artistic", "(?:perl )?artistic licen[cs]e", ("1", "2")),
    ("ofl", "open font", "(?:sil )?open font licen[cs]e", ("1", "1 1")),
    ("bsl", "boost software", "boost software licen[cs]e", ("1",)),
    ("busl", "business source", "business source licen[cs]e", ("1", "1 1")),
    ("sspl", "server side public", "server side public licen[cs]e", ("1",)),
    ("cecill", "cecill", "cecill(?: free software)? licen[cs]e", ("1", "1 1", "2", "2 1")),
    ("lppl", "latex project", "latex project public licen[cs]e", ("1", "1 1", "1 2", "1 3")),
    ("odbl", "open database", "open (?:data commons open )?database licen[cs]e", ("1",)),
    ("ogl", "open government", "open government licen[cs]e", ("1", "2", "3")),
    ("php", "php licen", "php licen[cs]e", ("2", "3", "3 1")),
    ("zpl", "zope public", "zope public licen[cs]e", ("1", "2", "2 1")),
    ("ecl", "educational community", "educational community licen[cs]e", ("1", "2")),
    ("qpl", "q public", "q public licen[cs]e", ("1",)),
    ("npl", "netscape public", "netscape public licen[cs]e", ("1", "1 1")),
    ("psf", "python software foundation", "python software foundation licen[cs]e", ("2",)),
    ("w3c", "w3c", "w3c software(?: and document)?(?: notice and)? licen[cs]e", ("1", "2")),
]
# Short tags by label stem and versions.
TAGS = [
    ("agpl", ("1", "3")),
    ("gpl", ("1", "2", "3")),
    ("lgpl", ("2", "2 1", "3")),
    ("mpl", ("1", "1 1", "2")),
    ("epl", ("1", "2")),
    ("eupl", ("1", "1 1", "1 2")),
    ("cddl", ("1", "1 1")),
    ("osl", ("1", "2", "2 1", "3")),
    ("afl", ("1", "2", "2 1", "3")),
    ("ofl", ("1", "1 1")),
    ("bsl", ("1",)),
    ("busl", ("1 1",)),
    ("sspl", ("1",)),
    ("apache", ("1", "1 1", "2")),
    ("artistic", ("1", "2")),
    ("cecill", ("1", "2", "2 1")),
    ("odbl", ("1",)),
    ("lppl", ("1", "1 2", "1 3")),
    ("gfdl", ("1 1", "1 2", "1 3")),
]
# The members of the Creative Commons family and their versions.
COMMONS = [
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative|ative work|ative works|s|atives)"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative|ative work|ative works|s|atives)"),
]
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# Notices without a version.
SINGLE = [
    ("mit", "mit licen", "(?:the )?mit licen[cs]e", NAMED),
    ("mit", "mit licen", "licensed under (?:the )?(?:terms of the )?mit licen[cs]e", GRANT),
    ("mit", "mit licen", "released under (?:the )?(?:terms of the )?mit licen[cs]e", GRANT),
    ("mit", "mit licen", "distributed under (?:the )?(?:terms of the )?mit licen[cs]e", GRANT),
    ("mit", "free of charge", "permission is hereby granted free of charge to any person obtaining a copy", GRANT),
    ("mit", "substantial portions", "shall be included in all copies or substantial portions of the software", GRANT),
    ("mit", "x11 licen", "x11 licen[cs]e", NAMED),
    ("mit", "expat licen", "expat licen[cs]e", NAMED),
    ("mit-0", "mit no attribution", "mit no attribution", NAMED),
    ("bsd", "bsd licen", "bsd licen[cs]e", NAMED),
    ("bsd", "bsd style", "bsd style licen[cs]e", NAMED),
    ("bsd", "binary forms", "redistribution and use in source and binary forms", GRANT),
    ("bsd-2", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd)", NAMED),
    ("bsd-2", "freebsd licen", "freebsd licen[cs]e", NAMED),
    ("bsd-3", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", NAMED),
    ("bsd-3", "endorse or promote", "may be used to endorse or promote products derived from this software", GRANT),
    ("bsd-4", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)", NAMED),
    ("bsd-4", "advertising materials", "all advertising materials mentioning features or use of this software", GRANT),
    ("0bsd", "0bsd", "0bsd", TAG),
    ("0bsd", "zero clause", "(?:bsd zero clause|zero clause bsd)", NAMED),
    ("isc", "isc licen", "isc licen[cs]e", NAMED),
    ("isc", "with or without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee", GRANT),
    ("zlib", "zlib licen", "zlib (?:libpng )?licen[cs]e", NAMED),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such", GRANT),
    ("unlicense", "unlicense", "(?:the )?unlicense", NAMED),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", GRANT),
    ("wtfpl", "wtfpl", "wtfpl", TAG),
    ("wtfpl", "do what the", "do what the [^ ]+ you want to public licen[cs]e", GRANT),
    ("beerware", "beer ware", "beer ware licen[cs]e", NAMED),
    ("beerware", "beerware", "beerware", TAG),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", GRANT),
    ("public-domain", "public domain", "this (?:work|text|document|file) is in the public domain", GRANT),
    ("public-domain", "public domain", "public domain dedication", NAMED),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", TAG),
    ("cc0", "creative commons zero", "creative commons zero", NAMED),
    ("cc0", "waived all copyright", "has waived all copyright and related or neighboring rights", GRANT),
    ("postgresql", "postgresql licen", "postgresql licen[cs]e", NAMED),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source licen[cs]e", NAMED),
    ("openssl", "openssl licen", "openssl licen[cs]e", NAMED),
    ("openssl", "openssl toolkit", "developed by the openssl project for use in the openssl toolkit", GRANT),
    ("curl", "curl licen", "curl licen[cs]e", NAMED),
    ("ruby", "ruby licen", "ruby licen[cs]e", NAMED),
    ("perl", "same terms as perl", "under the same terms as perl(?: itself)?", GRANT),
    ("vim", "vim licen", "vim licen[cs]e", NAMED),
    ("unicode", "unicode licen", "unicode licen[cs]e(?: agreement)?", NAMED),
    ("ms-pl", "microsoft public", "microsoft public licen[cs]e", NAMED),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal licen[cs]e", NAMED),
    ("json", "good not evil", "software shall be used for good not evil", GRANT),
    ("elastic", "elastic licen", "elastic licen[cs]e(?: 2 0)?", NAMED),
    ("commons-clause", "commons clause", "commons clause", NAMED),
    ("polyform", "polyform", "polyform [^ ]+(?: [^ ]+)? licen[cs]e", NAMED),
    ("blue-oak", "blue oak", "blue oak model licen[cs]e", NAMED),
    ("hippocratic", "hippocratic", "hippocratic licen[cs]e", NAMED),
    ("mulan", "mulan", "mulan (?:permissive software|public) licen[cs]e", NAMED),
    ("openrail", "openrail", "openrail(?: m)?", TAG),
    ("proprietary", "all rights reserved", "all rights reserved", TAG),
    ("proprietary", "rights reserved", "copyright (?:c )?[0-9]{4} " + gap(6) + "all rights reserved", GRANT),
    ("proprietary", "proprietary and confidential", "proprietary and confidential", NAMED),
    ("proprietary", "without permission", "may not be (?:reproduced|copied|distributed) (?:[^ ]+ ){0,8}without permission", GRANT),
    ("no-derivatives", "no derivative", "no derivative works", TAG),
    ("non-commercial", "non commercial", "for non commercial use only", NAMED),
    ("non-commercial", "noncommercial", "for noncommercial use only", NAMED),
    ("spdx", "spdx", "spdx license identifier " + "[^ ]+", TAG),
]
SPDX = ("mit", "apache 2 0", "gpl 2 0", "gpl 3 0", "lgpl 2 1", "lgpl 3 0", "agpl 3 0", "mpl 2 0", "bsd 2 clause", "bsd 3 clause", "isc", "cc0 1 0", "epl 2 0", "unlicense")
# Words that introduce a license.
GRANTING = "(?:licensed|released|distributed|published|available|made available|provided|redistribute it and or modify it|covered)"


def _tail(version: str) -> str:
    """A version whose last number is not followed by a further one, but for a zero."""
    return f"{version}(?: 0)?(?! [0-9])" if " " not in version else f"{version}(?! [0-9])"


def _name(stem: str, version: str) -> str:
    return f"{stem}-{version.replace(' ', '.')}"


def signatures() -> list[Signature]:
    """All rules in order; among equals the earlier one wins."""
    out: list[Signature] = []
    for stem, key, name, versions in VERSIONED:
        for v in versions:
            number = f"(?:v|ver|version |v ){{0,1}}{_tail(v)}"
            label = _name(stem, v)
            out.append(
                Signature(label, key, f"{GRANTING} under (?:the )?(?:terms of )?(?:the )?{name} {number}", GRANT)
            )
            out.append(Signature(label, key, f"{name} (?:as published by {gap(6)})?(?:either )?{number}", NAMED))
        out.append(Signature(stem, key, name, TAG))
    for stem, versions in TAGS:
        for v in versions:
            out.append(Signature(_name(stem, v), stem, f"{stem} ?v? ?{_tail(v)}", TAG))
    for label, short, long in COMMONS:
        for v in COMMONS_VERSIONS:
            named = f"{label}-{v.replace(' ', '.')}"
            out.append(Signature(named, "cc by", f"{GRANTING} under (?:a |the )?cc {short} {v}", GRANT))
            out.append(Signature(named, "cc by", f"cc {short} {v}", NAMED))
            out.append(
                Signature(named, "creative commons", f"creative commons {long} (?:[^ ]+ ){{0,2}}?{v}", NAMED)
            )
        out.append(Signature(label, "cc by", f"cc {short}", TAG))
        out.append(Signature(label, "creative commons", f"creative commons {long}", TAG))
    out += [Signature(*row) for row in SINGLE]
    for tag in SPDX:
        out.append(Signature(tag.replace(" ", "-"), "spdx", f"spdx license identifier {tag}", GRANT))
    return out
