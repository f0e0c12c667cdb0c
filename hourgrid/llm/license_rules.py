"""Signature rules of the licence scan: hand-written patterns by licence.

Each licence has a label, patterns for its name, patterns for its short forms, and
parts of its address. ``rules()`` makes the ordered list: for every licence a tag
rule, a name rule, a rule for "licensed under ..." with the name or a short form, an address
rule and, where a short form is clear enough alone, a mention rule.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    priority: int  # 1 is strongest
    label: str
    keyword: str  # lower case; a text without it can't match
    pattern: str  # Java and Python syntax
    confidence: float


_S = r"(?:[\s,;:_-]+)"
_V = r"(?:[\s,(]*+(?:version|ver\.?|v\.?)?\s*+)"
_THE = r"(?:the\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+)?(?:the\s+)?"

#: label, SPDX identifier, name, short form ("" if none), address ("" if none), short form stands alone
LICENCES = (
    ("gpl-1.0", r"GPL-1\.0(?:-only|-or-later|\+)?", rf"GNU\s+General\s+Public\s+Licen[sc]e{_V}1(?![.\d])", rf"GPL{_S}?v?1(?:\.0)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0", True),
    ("gpl-2.0", r"GPL-2\.0(?:-only|-or-later|\+)?", rf"GNU\s+General\s+Public\s+Licen[sc]e{_V}2", rf"GPL{_S}?v?2(?:\.0)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0", True),
    ("gpl-3.0", r"GPL-3\.0(?:-only|-or-later|\+)?", rf"GNU\s+General\s+Public\s+Licen[sc]e{_V}3", rf"GPL{_S}?v?3(?:\.0)?", r"gnu\.org/licenses/gpl-3\.0", True),
    ("gpl", r"GPL(?![-\w.])", r"GNU\s+General\s+Public\s+Licen[sc]e", r"(?:GNU\s+)?GPL", r"gnu\.org/(?:licenses/gpl|copyleft/gpl)", False),
    ("lgpl-2.0", r"LGPL-2\.0(?:-only|-or-later|\+)?", rf"GNU\s+Library\s+General\s+Public\s+Licen[sc]e{_V}2(?!\.1)", rf"LGPL{_S}?v?2(?:\.0)?(?![.\d])", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0", True),
    ("lgpl-2.1", r"LGPL-2\.1(?:-only|-or-later|\+)?", rf"GNU\s+Lesser\s+General\s+Public\s+Licen[sc]e{_V}2\.1", rf"LGPL{_S}?v?2\.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", True),
    ("lgpl-3.0", r"LGPL-3\.0(?:-only|-or-later|\+)?", rf"GNU\s+Lesser\s+General\s+Public\s+Licen[sc]e{_V}3", rf"LGPL{_S}?v?3(?:\.0)?", r"gnu\.org/licenses/lgpl-3\.0", True),
    ("lgpl", r"LGPL(?![-\w.])", r"GNU\s+(?:Lesser|Library)\s+General\s+Public\s+Licen[sc]e", r"(?:GNU\s+)?LGPL", r"gnu\.org/(?:licenses/lgpl|copyleft/lesser)", False),
    ("agpl-3.0", r"AGPL-3\.0(?:-only|-or-later|\+)?", r"GNU\s+Affero\s+General\s+Public\s+Licen[sc]e", rf"(?:GNU\s+)?AGPL(?:{_S}?v?3(?:\.0)?)?", r"gnu\.org/licenses/agpl", True),
    ("gfdl", r"GFDL-1\.[1-3](?:-only|-or-later)?", r"GNU\s+Free\s+Documentation\s+Licen[sc]e", r"(?:GNU\s+)?GFDL", r"gnu\.org/(?:licenses/fdl|copyleft/fdl)", True),
    ("apache-1.1", r"Apache-1\.1", rf"Apache(?:\s+Software)?\s+Licen[sc]e{_V}1\.1", r"Apache[\s-]1\.1", r"apache\.org/licenses/LICENSE-1\.1", True),
    ("apache-2.0", r"Apache-2\.0", rf"Apache(?:\s+Software)?\s+Licen[sc]e{_V}2(?:\.0)?", r"Apache[\s-]2(?:\.0)?|ASL\s+2(?:\.0)?", r"apache\.org/licenses/LICENSE-2\.0", True),
    ("mit", r"MIT(?![-\w])", r"(?:The\s+)?MIT\s+(?:/\s*X11\s+)?Licen[sc]e", r"MIT(?!\w)", r"opensource\.org/licenses/MIT", False),
    ("mit-0", r"MIT-0", r"MIT\s+No\s+Attribution(?:\s+Licen[sc]e)?", r"MIT-0", r"opensource\.org/licenses/MIT-0", True),
    ("x11", r"X11(?![-\w])", r"X11\s+Licen[sc]e", r"X11\s+terms", r"spdx\.org/licenses/X11", False),
    ("bsd-2-clause", r"BSD-2-Clause(?:-\w+)?", r"(?:Simplified|FreeBSD|2[\s-]clause)\s+BSD\s+Licen[sc]e|BSD\s+2[\s-]clause(?:\s+Licen[sc]e)?", r"BSD[\s-]2[\s-]clause", r"opensource\.org/licenses/BSD-2-Clause", True),
    ("bsd-3-clause", r"BSD-3-Clause(?:-\w+)?", r"(?:New|Modified|Revised|3[\s-]clause)\s+BSD\s+Licen[sc]e|BSD\s+3[\s-]clause(?:\s+Licen[sc]e)?", r"BSD[\s-]3[\s-]clause", r"opensource\.org/licenses/BSD-3-Clause", True),
    ("bsd-4-clause", r"BSD-4-Clause", r"(?:Original|4[\s-]clause)\s+BSD\s+Licen[sc]e|BSD\s+4[\s-]clause", r"BSD[\s-]4[\s-]clause", r"spdx\.org/licenses/BSD-4-Clause", True),
    ("0bsd", r"0BSD", r"(?:Zero[\s-]clause|Free\s+Public)\s+BSD\s+Licen[sc]e|BSD\s+Zero\s+Clause", r"0BSD", r"opensource\.org/licenses/0BSD", True),
    ("bsd", r"BSD(?![-\w])", r"BSD[\s-](?:style\s+)?Licen[sc]e", r"BSD(?![-\w])", r"opensource\.org/licenses/bsd-license", False),
    ("isc", r"ISC(?![-\w])", r"ISC\s+Licen[sc]e", r"ISC\s+terms", r"opensource\.org/licenses/ISC", False),
    ("mpl-1.1", r"MPL-1\.1", rf"Mozilla\s+Public\s+Licen[sc]e{_V}1\.1", r"MPL[\s-]?v?1\.1", r"mozilla\.org/MPL/1\.1", True),
    ("mpl-2.0", r"MPL-2\.0(?:-\w+)*", rf"Mozilla\s+Public\s+Licen[sc]e{_V}2(?:\.0)?", r"MPL[\s-]?v?2(?:\.0)?", r"mozilla\.org/(?:en-US/)?MPL/2\.0", True),
    ("epl-1.0", r"EPL-1\.0", rf"Eclipse\s+Public\s+Licen[sc]e{_V}1(?:\.0)?", r"EPL[\s-]?v?1(?:\.0)?", r"eclipse\.org/legal/epl-v10", True),
    ("epl-2.0", r"EPL-2\.0", rf"Eclipse\s+Public\s+Licen[sc]e{_V}2(?:\.0)?", r"EPL[\s-]?v?2(?:\.0)?", r"eclipse\.org/legal/epl-(?:v20|2\.0)", True),
    ("cddl-1.0", r"CDDL-1\.[01]", r"Common\s+Development\s+and\s+Distribution\s+Licen[sc]e", r"CDDL(?:[\s-]?v?1\.[01])?", r"opensource\.org/licenses/CDDL", True),
    ("cpl-1.0", r"CPL-1\.0", r"Common\s+Public\s+Licen[sc]e", r"CPL[\s-]1\.0", r"opensource\.org/licenses/CPL", True),
    ("eupl-1.2", r"EUPL-1\.[0-2]", r"European\s+Union\s+Public\s+Licen[sc]e", r"EUPL(?:[\s-]?v?1\.[0-2])?", r"joinup\.ec\.europa\.eu/\S*eupl", True),
    ("osl-3.0", r"OSL-[123]\.[01]", r"Open\s+Software\s+Licen[sc]e", r"OSL[\s-]?v?[123]\.[01]", r"opensource\.org/licenses/OSL", True),
    ("afl-3.0", r"AFL-[123]\.[012]", r"Academic\s+Free\s+Licen[sc]e", r"AFL[\s-]?v?[123]\.[012]", r"opensource\.org/licenses/AFL", True),
    ("artistic-1.0", r"Artistic-1\.0(?:-\w+)?", rf"Artistic\s+Licen[sc]e{_V}1(?:\.0)?", r"Artistic[\s-]1(?:\.0)?", r"opensource\.org/licenses/Artistic-1\.0", True),
    ("artistic-2.0", r"Artistic-2\.0", rf"Artistic\s+Licen[sc]e{_V}2(?:\.0)?", r"Artistic[\s-]2(?:\.0)?", r"opensource\.org/licenses/Artistic-2\.0", True),
    ("bsl-1.0", r"BSL-1\.0", r"Boost\s+Software\s+Licen[sc]e", r"BSL[\s-]1\.0", r"boost\.org/LICENSE_1_0", True),
    ("busl-1.1", r"BUSL-1\.1", r"Business\s+Source\s+Licen[sc]e", r"BUSL(?:[\s-]1\.1)?", r"mariadb\.com/bsl", True),
    ("sspl-1.0", r"SSPL-1\.0", r"Server\s+Side\s+Public\s+Licen[sc]e", r"SSPL(?:[\s-]?v?1)?", r"mongodb\.com/licensing/server-side-public-license", True),
    ("elastic-2.0", r"Elastic-2\.0", r"Elastic\s+Licen[sc]e(?:\s+(?:version\s+)?2(?:\.0)?)?", r"ELv2", r"elastic\.co/licensing/elastic-license", True),
    ("zlib", r"Zlib(?![-\w])", r"zlib(?:/libpng)?\s+Licen[sc]e", r"zlib\s+terms", r"opensource\.org/licenses/Zlib", False),
    ("libpng", r"libpng(?:-2\.0)?", r"(?:PNG\s+Reference\s+Library|libpng)\s+Licen[sc]e", r"libpng\s+terms", r"libpng\.org/pub/png/src/libpng-LICENSE", False),
    ("python-2.0", r"(?:Python|PSF)-2\.0", r"Python(?:\s+Software\s+Foundation)?\s+Licen[sc]e", r"PSF(?:\s+Licen[sc]e)", r"python\.org/psf/license", False),
    ("ruby", r"Ruby(?![-\w])", r"Ruby\s+Licen[sc]e", r"Ruby's\s+terms", r"ruby-lang\.org/en/about/license", False),
    ("php-3.01", r"PHP-3\.0?1?", r"PHP\s+Licen[sc]e", r"PHP[\s-]3\.01", r"php\.net/license/3_01", True),
    ("postgresql", r"PostgreSQL(?![-\w])", r"PostgreSQL\s+Licen[sc]e", r"PostgreSQL\s+terms", r"opensource\.org/licenses/PostgreSQL", False),
    ("openssl", r"OpenSSL(?![-\w])", r"OpenSSL\s+Licen[sc]e", r"OpenSSL\s+terms", r"openssl\.org/source/license", False),
    ("curl", r"curl(?![-\w])", r"curl\s+Licen[sc]e", r"curl\s+terms", r"curl\.se/docs/copyright", False),
    ("unlicense", r"Unlicense", r"(?:The\s+)?Unlicense(?!d)", r"Unlicense(?!d)", r"unlicense\.org", True),
    ("wtfpl", r"WTFPL", r"Do\s+What\s+The\s+F\S+\s+You\s+Want\s+To\s+Public\s+Licen[sc]e", r"WTFPL", r"wtfpl\.net", True),
    ("beerware", r"Beerware", r"(?:THE\s+)?BEER-?WARE\s+Licen[sc]e", r"Beerware", r"people\.freebsd\.org/~phk", True),
    ("cc0-1.0", r"CC0-1\.0", r"Creative\s+Commons\s+(?:Zero|CC0)(?:\s+1\.0)?(?:\s+Universal)?", r"CC0", r"creativecommons\.org/publicdomain/zero", True),
    ("cc-by-2.0", r"CC-BY-2\.0", rf"Creative\s+Commons\s+Attribution{_V}2\.0", r"CC[\s-]BY[\s-]2\.0", r"creativecommons\.org/licenses/by/2\.0", True),
    ("cc-by-3.0", r"CC-BY-3\.0", rf"Creative\s+Commons\s+Attribution{_V}3\.0", r"CC[\s-]BY[\s-]3\.0", r"creativecommons\.org/licenses/by/3\.0", True),
    ("cc-by-4.0", r"CC-BY-4\.0", rf"Creative\s+Commons\s+Attribution{_V}4\.0", r"CC[\s-]BY[\s-]4\.0", r"creativecommons\.org/licenses/by/4\.0", True),
    ("cc-by-sa-2.0", r"CC-BY-SA-2\.0", rf"Creative\s+Commons\s+Attribution[\s-]Share\s?Alike{_V}2\.0", r"CC[\s-]BY[\s-]SA[\s-]2\.0", r"creativecommons\.org/licenses/by-sa/2\.0", True),
    ("cc-by-sa-3.0", r"CC-BY-SA-3\.0", rf"Creative\s+Commons\s+Attribution[\s-]Share\s?Alike{_V}3\.0", r"CC[\s-]BY[\s-]SA[\s-]3\.0", r"creativecommons\.org/licenses/by-sa/3\.0", True),
    ("cc-by-sa-4.0", r"CC-BY-SA-4\.0", rf"Creative\s+Commons\s+Attribution[\s-]Share\s?Alike{_V}4\.0", r"CC[\s-]BY[\s-]SA[\s-]4\.0", r"creativecommons\.org/licenses/by-sa/4\.0", True),
    ("cc-by-nc-3.0", r"CC-BY-NC-3\.0", rf"Creative\s+Commons\s+Attribution[\s-]Non-?\s?Commercial{_V}3\.0", r"CC[\s-]BY[\s-]NC[\s-]3\.0", r"creativecommons\.org/licenses/by-nc/3\.0", True),
    ("cc-by-nc-4.0", r"CC-BY-NC-4\.0", rf"Creative\s+Commons\s+Attribution[\s-]Non-?\s?Commercial{_V}4\.0", r"CC[\s-]BY[\s-]NC[\s-]4\.0", r"creativecommons\.org/licenses/by-nc/4\.0", True),
    ("cc-by-nd-4.0", r"CC-BY-ND-[34]\.0", r"Creative\s+Commons\s+Attribution[\s-]No\s?-?Deriv\w+", r"CC[\s-]BY[\s-]ND(?:[\s-][34]\.0)?", r"creativecommons\.org/licenses/by-nd", True),
    ("cc-by-nc-sa-4.0", r"CC-BY-NC-SA-[34]\.0", r"Creative\s+Commons\s+Attribution[\s-]Non-?\s?Commercial[\s-]Share\s?Alike", r"CC[\s-]BY[\s-]NC[\s-]SA(?:[\s-][34]\.0)?", r"creativecommons\.org/licenses/by-nc-sa", True),
    ("cc-by-nc-nd-4.0", r"CC-BY-NC-ND-[34]\.0", r"Creative\s+Commons\s+Attribution[\s-]Non-?\s?Commercial[\s-]No\s?-?Deriv\w+", r"CC[\s-]BY[\s-]NC[\s-]ND(?:[\s-][34]\.0)?", r"creativecommons\.org/licenses/by-nc-nd", True),
    ("cc-by-sa", r"CC-BY-SA(?![-\w])", r"Creative\s+Commons\s+Attribution[\s-]Share\s?Alike", r"CC[\s-]BY[\s-]SA", r"creativecommons\.org/licenses/by-sa", True),
    ("cc-by-nc", r"CC-BY-NC(?![-\w])", r"Creative\s+Commons\s+Attribution[\s-]Non-?\s?Commercial", r"CC[\s-]BY[\s-]NC", r"creativecommons\.org/licenses/by-nc", True),
    ("cc-by", r"CC-BY(?![-\w])", r"Creative\s+Commons\s+Attribution(?:\s+Licen[sc]e)?", r"CC[\s-]BY", r"creativecommons\.org/licenses/by/", True),
    ("odbl-1.0", r"ODbL-1\.0", r"Open\s+(?:Data\s+Commons\s+Open\s+)?Database\s+Licen[sc]e", r"ODbL", r"opendatacommons\.org/licenses/odbl", True),
    ("odc-by-1.0", r"ODC-By-1\.0", r"Open\s+Data\s+Commons\s+Attribution\s+Licen[sc]e", r"ODC[\s-]BY", r"opendatacommons\.org/licenses/by", True),
    ("pddl-1.0", r"PDDL-1\.0", r"(?:Open\s+Data\s+Commons\s+)?Public\s+Domain\s+Dedication\s+and\s+Licen[sc]e", r"PDDL", r"opendatacommons\.org/licenses/pddl", True),
    ("cdla-permissive-2.0", r"CDLA-Permissive-[12]\.0", r"Community\s+Data\s+Licen[sc]e\s+Agreement[\s–-]+Permissive", r"CDLA[\s-]Permissive", r"cdla\.dev/permissive", True),
    ("cdla-sharing-1.0", r"CDLA-Sharing-1\.0", r"Community\s+Data\s+Licen[sc]e\s+Agreement[\s–-]+Sharing", r"CDLA[\s-]Sharing", r"cdla\.dev/sharing", True),
    ("ogl-3.0", r"OGL-UK-[123]\.0", r"Open\s+Government\s+Licen[sc]e", r"OGL(?:[\s-]?v?[123](?:\.0)?)?", r"nationalarchives\.gov\.uk/doc/open-government-licence", False),
    ("openrail", r"(?:BigScience-)?OpenRAIL(?:-M|-\+\+)?", r"(?:BigScience\s+|CreativeML\s+)?Open\s?RAIL(?:[\s+-]*M)?(?:\s+Licen[sc]e)?", r"OpenRAIL", r"huggingface\.co/\S*license", True),
    ("ofl-1.1", r"OFL-1\.1(?:-\w+)?", r"SIL\s+Open\s+Font\s+Licen[sc]e", r"OFL[\s-]?1\.1", r"scripts\.sil\.org/OFL", True),
    ("ms-pl", r"MS-PL", r"Microsoft\s+Public\s+Licen[sc]e", r"MS-PL", r"opensource\.org/licenses/MS-PL", True),
    ("ms-rl", r"MS-RL", r"Microsoft\s+Reciprocal\s+Licen[sc]e", r"MS-RL", r"opensource\.org/licenses/MS-RL", True),
    ("ecl-2.0", r"ECL-2\.0", r"Educational\s+Community\s+Licen[sc]e", r"ECL[\s-]2\.0", r"opensource\.org/licenses/ECL-2\.0", True),
    ("upl-1.0", r"UPL-1\.0", r"Universal\s+Permissive\s+Licen[sc]e", r"UPL[\s-]1\.0", r"opensource\.org/licenses/UPL", True),
    ("ncsa", r"NCSA(?![-\w])", r"(?:University\s+of\s+Illinois/)?NCSA\s+Open\s+Source\s+Licen[sc]e", r"NCSA\s+terms", r"opensource\.org/licenses/NCSA", False),
    ("mulanpsl-2.0", r"MulanPSL-[12]\.0", r"Mulan\s+Permissive\s+Software\s+Licen[sc]e", r"Mulan\s?PSL", r"license\.coscl\.org\.cn/MulanPSL", True),
    ("vim", r"Vim(?![-\w])", r"Vim\s+Licen[sc]e", r"Vim\s+terms", r"vimhelp\.org/uganda", False),
    ("w3c", r"W3C(?:-\d+)?", r"W3C\s+Software\s+(?:Notice\s+and\s+)?Licen[sc]e", r"W3C\s+terms", r"w3\.org/Consortium/Legal", False),
    ("json", r"JSON(?![-\w])", r"JSON\s+Licen[sc]e", r"JSON\s+terms", r"json\.org/license", False),
)

#: Notices that name no licence: label, keyword, pattern, priority, confidence. A keyword is one
#: word: white space between words may be a line end.
NOTICES = (
    ("all-rights-reserved", "reserved", r"All\s+rights\s+reserved", 4, 0.7),
    ("copyright-notice", "copyright", r"Copyright\s*+(?:\(c\)|©)?\s*+(?:19|20)\d{2}", 4, 0.4),
    ("copyright-notice", "©", r"©\s*+(?:19|20)\d{2}", 4, 0.4),
    ("public-domain", "domain", r"(?:(?:is|are)\s+(?:in|released\s+(?:in)?to)|dedicated\s+to)\s+the\s+public\s+domain", 3, 0.8),
    ("proprietary", "proprietary", r"proprietary\s+and\s+confidential|proprietary\s+licen[sc]e", 3, 0.8),
    ("no-redistribution", "copied", r"(?:may|must)\s+not\s+be\s+copied(?:\s+or\s+\w+)*", 4, 0.6),
    ("no-redistribution", "reproduced", r"(?:may|must)\s+not\s+be\s+reproduced(?:\s+or\s+\w+)*", 4, 0.6),
    ("no-redistribution", "redistributed", r"(?:may|must)\s+not\s+be\s+redistributed(?:\s+or\s+\w+)*", 4, 0.6),
    ("no-redistribution", "redistribution", r"redistribution\s+(?:is\s+)?(?:strictly\s+)?prohibited", 4, 0.6),
    ("non-commercial", "commercial", r"for\s+non-?\s?commercial\s+(?:use|purposes)(?:\s+only)?", 4, 0.5),
    ("mit-text", "permission", r"Permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge,?\s+to\s+any\s+person", 2, 0.95),
    ("bsd-text", "redistribution", r"Redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms", 2, 0.9),
    ("isc-text", "permission", r"Permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute", 2, 0.9),
    ("warranty-disclaimer", "warrant", r"without\s+warrant(?:y|ies)\s+of\s+any\s+kind", 5, 0.3),
    ("licensed-unknown", "licen", r"Licen[sc]ed\s+under\s+(?:the\s+)?", 6, 0.2),
)


#: Short forms that share no keyword are rules of their own: keyword, pattern.
MENTIONS = {"apache-2.0": (("apache", r"Apache[\s-]2(?:\.0)?"), ("asl", r"ASL\s+2(?:\.0)?"))}


def _word(pattern: str) -> str:
    return rf"(?i)(?<![A-Za-z0-9])(?:{pattern})(?![A-Za-z0-9])"


def _clue(pattern: str) -> str:
    """The keyword of an address: its host, in lower case."""
    return pattern.split("/")[0].replace("\\", "").lower()


def rules() -> list[Rule]:
    """All rules, strongest first; equal priorities keep the order above."""
    out = []
    for label, spdx, name, short, address, clear in LICENCES:
        out.append(Rule(1, label, "spdx-license", rf"(?i)SPDX-License-Identifier\s*:\s*\(?\s*{spdx}(?![A-Za-z0-9])", 1.0))
        out.append(Rule(2, label, _name_clue(label, name), _word(name), 0.95))
        out.append(Rule(3, label, "licen", rf"(?i)(?<![A-Za-z0-9])Licen[sc]ed\s+under\s+{_THE}(?:{name}|{short})(?![A-Za-z0-9])", 0.9))
        out.append(Rule(3, label, _clue(address), rf"(?i){address}", 0.85))
        if clear:
            for keyword, part in MENTIONS.get(label, ((_short_clue(label), short),)):
                out.append(Rule(5, label, keyword, _word(part), 0.6))
    out += [Rule(priority, label, keyword, rf"(?i){pattern}", confidence) for label, keyword, pattern, priority, confidence in NOTICES]
    return sorted(out, key=lambda r: r.priority)


def _name_clue(label: str, name: str) -> str:
    if label.startswith("cc"):
        return "creative"
    return {"openrail": "rail", "unlicense": "unlicense", "mit-0": "attribution", "0bsd": "bsd", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd",
            "bsd-4-clause": "bsd"}.get(label, "licen")


def _short_clue(label: str) -> str:
    return {"artistic-1.0": "artistic", "artistic-2.0": "artistic", "mit-0": "mit-0", "ms-pl": "ms-pl", "ms-rl": "ms-rl", "elastic-2.0": "elv2", "mulanpsl-2.0": "mulan",
            "eupl-1.2": "eupl", "sspl-1.0": "sspl", "unlicense": "unlicense"}.get(label, label.split("-")[0])


#: The keywords of all rules: a text without any of them matches no rule.
ANCHORS = tuple(sorted({r.keyword for r in rules()}))
