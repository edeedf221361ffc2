"""The rules of the license scan: (priority, label, keyword, pattern, confidence).

Patterns see lower-case words with one blank between them; a rule is tried only on texts that hold its keyword. Lower
priorities win between detections of the same words. Families are written by hand, their versions by rule.
"""

from __future__ import annotations

#: A plus sign behind a number, as in "GPLv2+", is the word "plus" here.
_LATER, _ONLY = r"(?: (?:or|and)(?: at your option)? (?:any )?(?:later|newer)(?: versions?)?| plus)", r" only"


def _version(version: str) -> str:
    """How a version is written: 'version 2 0', 'v2', 'v 2 0', '2 0', and 'v2' or '2' right behind the name."""
    major, _, minor = version.partition(".")
    return rf"(?: (?:the )?(?:version|ver|v))? ?v?{major}" + (rf"(?: {minor})?" if minor in ("", "0") else rf" {minor}")


def _family(label: str, keyword: str, names: str, versions: str = "", later: bool = False) -> list[tuple[int, str, str, str, float]]:
    out = [(30, label, keyword, rf"(?:{names})", 0.8)]
    for v in versions.split():
        base = rf"(?:{names}){_version(v)}"
        out.append((20, f"{label}-{v}", keyword, base, 0.95))
        if later:
            out.append((10, f"{label}-{v}-or-later", keyword, base + _LATER, 1.0))
            out.append((10, f"{label}-{v}-only", keyword, base + _ONLY, 1.0))
    return out


def _rules() -> list[tuple[int, str, str, str, float]]:
    rules = []
    gnu, licence = r"(?:the )?(?:gnu )?", r"(?: public)? licen[cs]e"
    rules += _family("gpl", "general", rf"(?:the )?gnu general{licence}|(?:the )?general public licen[cs]e", "1.0 2.0 3.0", later=True)
    rules += _family("gpl", "gpl", r"(?:gnu )?gpl", "1.0 2.0 3.0", later=True)
    rules += _family("lgpl", "lesser general", rf"{gnu}lesser general{licence}", "2.1 3.0", later=True)
    rules += _family("lgpl", "library general", rf"{gnu}library general{licence}", "2.0", later=True)
    rules += _family("lgpl", "lgpl", r"(?:gnu )?lgpl", "2.0 2.1 3.0", later=True)
    rules += _family("agpl", "affero", rf"{gnu}affero general{licence}", "1.0 3.0", later=True)
    rules += _family("agpl", "agpl", r"(?:gnu )?agpl", "1.0 3.0", later=True)
    rules += _family("gfdl", "free documentation", rf"{gnu}free documentation licen[cs]e", "1.1 1.2 1.3", later=True)
    rules += _family("apache", "apache", r"apache(?: software)? licen[cs]e|licensed under apache", "1.0 1.1 2.0")
    rules += _family("mpl", "mozilla", r"mozilla public licen[cs]e", "1.0 1.1 2.0")
    for short, versions in (("mpl", "1.0 1.1 2.0"), ("epl", "1.0 2.0"), ("cddl", "1.0 1.1"), ("eupl", "1.0 1.1 1.2"), ("ofl", "1.0 1.1"), ("osl", "2.1 3.0"), ("afl", "2.1 3.0"), ("sspl", "1.0"), ("upl", "1.0")):
        rules += _family(short, f" {short}", rf"{short}(?: licen[cs]ed?)?", versions)[1:]  # too short to mean it without a version
    rules += _family("apache", "apache", r"apache(?: software foundation)?(?: licen[cs]ed?)?", "1.1 2.0")[1:]
    rules += _family("epl", "eclipse", r"eclipse public licen[cs]e", "1.0 2.0")
    rules += _family("edl", "eclipse", r"eclipse distribution licen[cs]e", "1.0")
    rules += _family("cddl", "common development", r"common development and distribution licen[cs]e", "1.0 1.1")
    rules += _family("cpl", "common public", r"common public licen[cs]e", "1.0")
    rules += _family("cpal", "common public attribution", r"common public attribution licen[cs]e", "1.0")
    rules += _family("artistic", "artistic", r"(?:perl )?artistic licen[cs]e", "1.0 2.0")
    rules += _family("eupl", "european union public", r"european union public licen[cs]e", "1.0 1.1 1.2")
    rules += _family("ofl", "open font", r"(?:sil )?open font licen[cs]e", "1.0 1.1")
    rules += _family("osl", "open software licen", r"open software licen[cs]e", "1.0 2.0 2.1 3.0")
    rules += _family("afl", "academic free", r"academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0")
    rules += _family("cecill", "cecill", r"cecill(?: free software)?(?: licen[cs]e)?", "1.0 1.1 2.0 2.1")
    rules += _family("bsl", "boost", r"boost software licen[cs]e", "1.0")
    rules += _family("python", "python", r"python(?: software foundation)? licen[cs]e", "2.0")
    rules += _family("php", "php", r"php licen[cs]e", "3.0 3.01")
    rules += _family("zpl", "zope", r"zope public licen[cs]e", "1.1 2.0 2.1")
    rules += _family("ms-pl", "microsoft", r"microsoft public licen[cs]e")
    rules += _family("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e")
    rules += _family("apsl", "apple", r"apple public source licen[cs]e", "1.0 1.1 1.2 2.0")
    rules += _family("sspl", "server side public", r"server side public licen[cs]e", "1.0")
    rules += _family("busl", "business source", r"business source licen[cs]e", "1.0 1.1")
    rules += _family("elastic", "elastic", r"elastic licen[cs]e", "1.0 2.0")
    rules += _family("odbl", "open database", r"open (?:data commons open )?database licen[cs]e", "1.0")
    rules += _family("odc-by", "open data commons", r"open data commons attribution licen[cs]e", "1.0")
    rules += _family("pddl", "public domain dedication", r"(?:open data commons )?public domain dedication and licen[cs]e", "1.0")
    rules += _family("lppl", "latex", r"latex project public licen[cs]e", "1.0 1.1 1.2 1.3")
    rules += _family("ecl", "educational community", r"educational community licen[cs]e", "1.0 2.0")
    rules += _family("ipl", "ibm public", r"ibm public licen[cs]e", "1.0")
    rules += _family("npl", "netscape", r"netscape public licen[cs]e", "1.0 1.1")
    rules += _family("qpl", "q public", r"q public licen[cs]e", "1.0")
    rules += _family("spl", "sun public", r"sun public licen[cs]e", "1.0")
    rules += _family("w3c", "w3c", r"w3c software(?: notice and)? licen[cs]e")
    rules += _family("upl", "universal permissive", r"universal permissive licen[cs]e", "1.0")
    rules += _family("mulan-psl", "mulan", r"mulan (?:permissive software|psl) ?(?:licen[cs]e)?", "1.0 2.0")
    rules += _family("openrail", "openrail", r"(?:bigscience |creativeml )?openrail(?: m)?(?: licen[cs]e)?")
    rules += _family("llama", "llama", r"llama(?: [0-9])? community licen[cs]e")
    rules += _family("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e")
    rules += _family("isc", "isc", r"isc licen[cs]ed?")
    rules += _family("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e")
    rules += _family("openssl", "openssl", r"openssl licen[cs]e")
    rules += _family("postgresql", "postgresql", r"postgresql licen[cs]e")
    rules += _family("unlicense", "unlicense", r"(?:the )?unlicense")
    rules += _family("wtfpl", "what the fuck", r"do what the fuck you want to public licen[cs]e", "1.0 2.0")
    rules += _family("wtfpl", "wtfpl", r"wtfpl", "2.0")
    rules += _family("vim", "vim", r"vim licen[cs]e")
    rules += _family("sleepycat", "sleepycat", r"sleepycat licen[cs]e")
    rules += _family("json", "json", r"json licen[cs]e")
    rules += _family("beerware", "beer", r"beer ?ware licen[cs]e")
    rules += _family("commons-clause", "commons clause", r"commons clause")
    for clauses, words_ in (("0", "0|zero"), ("1", "1|one"), ("2", "2|two|simplified|freebsd"), ("3", "3|three|new|modified|revised"), ("4", "4|four|original|old")):
        rules.append((20, f"bsd-{clauses}-clause", "bsd", rf"(?:{words_})(?: clause)? bsd(?: style)?(?: licen[cs]ed?)?|bsd (?:{words_})(?: clause)?(?: licen[cs]e)?", 0.95))
    rules.append((30, "bsd", "bsd", r"bsd(?: style)? licen[cs]ed?", 0.8))
    for label, name in (("mit", "mit"), ("mit", "mit x11"), ("x11", "x11"), ("expat", "expat")):
        rules.append((30, label, f"{name} licen", rf"(?:the )?{name} licen[cs]e[sd]?", 0.8))
        for article in ("", "the "):
            rules.append((20, label, f"under {article}{name}", rf"(?:released|licensed|distributed|available) under {article}{name}(?: licen[cs]e)?", 0.95))
    for short in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        words_ = short.replace("-", " ")
        long_ = " ".join({"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}[x] for x in short.split("-"))
        for keyword, names in (("cc by", f"cc {words_}"), ("creative commons", f"creative commons {long_}")):
            rules += [(25, f"cc-{short}", keyword, names, 0.85)]
            rules += [(15, f"cc-{short}-{v}", keyword, rf"{names}(?: licen[cs]e)?(?: version)? {v.replace('.', ' ')}(?: (?:international|unported|generic) licen[cs]e)?", 1.0) for v in ("1.0", "2.0", "2.5", "3.0", "4.0")]
    rules += [
        (20, "cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 0.95),
        (40, "creative-commons", "creative commons", r"creative commons(?: licen[cs]e)?", 0.6),
        (40, "public-domain", "public domain", r"(?:in|into|to) the public domain", 0.6),
        (20, "mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 1.0),
        (20, "isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 1.0),
        (20, "bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted", 1.0),
        (20, "zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", 0.9),
        (20, "apache-2.0", "apache org", r"www apache org licen[cs]es licen[cs]e 2 0", 1.0),
        (20, "gpl", "gnu org", r"www gnu org (?:licen[cs]es|copyleft)(?: gpl)?(?: html)?", 0.7),
        (50, "proprietary", "all rights reserved", r"all rights reserved", 0.4),
        (50, "proprietary", "proprietary", r"proprietary and confidential|confidential and proprietary", 0.7),
        (60, "copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}", 0.4),
        (70, "license-reference", " under", r"(?:licensed|licenced|released|distributed) under(?: the)?(?: terms of)?(?: the)?", 0.3),
        (70, "license-reference", "licen", r"see (?:the )?licen[cs]e(?: file)?(?: for)?", 0.3),
    ]
    for spdx in "mit apache-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0-only gpl-3.0-or-later lgpl-2.1-only lgpl-3.0-only agpl-3.0-only mpl-2.0 bsd-2-clause bsd-3-clause isc epl-2.0 unlicense cc0-1.0 cc-by-4.0 cc-by-sa-4.0 zlib bsl-1.0 artistic-2.0 eupl-1.2 ofl-1.1".split():
        rules.append((5, spdx, "spdx", rf"spdx licen[cs]e identifier {spdx.replace('-', ' ').replace('.', ' ')}", 1.0))
    return sorted(rules, key=lambda r: r[0])


RULES = _rules()
