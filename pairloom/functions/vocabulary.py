"""Fixed values of normalisation and features: word lists, lookup tables, weights and patterns that define the results."""

from __future__ import annotations

#: Writings of an absent value.
MISSING = (
    "", "none", "null", "nan", "na", "n/a", "n a", "-", "--", "nil", "not available", "unknown",
)

#: Abbreviations in names.
NAME_ABBREV = {
    "pvt": "private", "pvtltd": "private limited", "prv": "private", "priv": "private", "ltd": "limited",
    "ltda": "limited", "lmt": "limited", "ld": "limited", "corp": "corporation", "corpn": "corporation",
    "co": "company", "cos": "companies", "inc": "incorporated", "incorp": "incorporated", "intl": "international",
    "int'l": "international", "natl": "national", "mfg": "manufacturing", "mfrs": "manufacturers",
    "mfr": "manufacturer", "svc": "services", "svcs": "services", "serv": "services", "srvs": "services",
    "assoc": "associates", "assocs": "associates", "bros": "brothers", "bro": "brother", "mgmt": "management",
    "mgt": "management", "dev": "development", "devt": "development", "eng": "engineering", "engg": "engineering",
    "engr": "engineering", "ent": "enterprises", "entp": "enterprises", "enterprise": "enterprises",
    "ind": "industries", "inds": "industries", "industry": "industries", "tech": "technologies",
    "technology": "technologies", "tecnologies": "technologies", "sys": "systems", "sol": "solutions",
    "soln": "solutions", "solns": "solutions", "grp": "group", "hldgs": "holdings", "hldg": "holdings",
    "invest": "investments", "dept": "department", "univ": "university", "inst": "institute", "hosp": "hospital",
    "mkt": "market", "mkts": "markets", "rest": "restaurant", "resto": "restaurant", "ctr": "center",
    "centre": "center", "cntr": "center", "phar": "pharmacy", "st": "saint", "ste": "sainte", "mt": "mount",
    "et": "and", "und": "and", "cie": "compagnie", "ets": "etablissements", "sct": "societe",
}

#: Abbreviations in addresses; an empty value deletes the word.
ADDR_ABBREV = {
    "rd": "road", "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "avn": "avenue",
    "blvd": "boulevard", "bd": "boulevard", "boul": "boulevard", "bvd": "boulevard", "ln": "lane", "dr": "drive",
    "drv": "drive", "ct": "court", "crt": "court", "pl": "place", "hwy": "highway", "hway": "highway",
    "pkwy": "parkway", "pky": "parkway", "sq": "square", "ste": "suite", "apt": "apartment", "apts": "apartments",
    "fl": "floor", "flr": "floor", "bldg": "building", "bld": "building", "cir": "circle", "ter": "terrace",
    "terr": "terrace", "trl": "trail", "expy": "expressway", "fwy": "freeway", "tpke": "turnpike", "cres": "crescent",
    "n": "north", "s": "south", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest", "se": "southeast",
    "sw": "southwest", "mt": "mount", "ft": "fort", "pt": "point", "hts": "heights", "jct": "junction",
    "opp": "opposite", "nr": "near", "nxt": "next", "bhd": "behind", "mkt": "market", "stn": "station",
    "rly": "railway", "sec": "sector", "sect": "sector", "ph": "", "tel": "", "phone": "", "mob": "", "mobile": "",
    "contact": "", "extn": "extension", "ext": "extension", "chk": "chowk", "clny": "colony", "col": "colony",
    "ngr": "nagar", "bazar": "bazaar", "sal": "salai", "mg": "mahatma gandhi", "r": "rue", "ch": "chemin",
    "imp": "impasse", "all": "allee", "rte": "route", "fbg": "faubourg", "qu": "quai", "crs": "cours",
    "za": "zone activite", "zi": "zone industrielle", "cedex": "", "bp": "", "null": "", "nan": "", "none": "",
    "saint": "street", "first": "1", "second": "2", "third": "3", "fourth": "4", "fifth": "5", "sixth": "6",
    "seventh": "7", "eighth": "8", "ninth": "9", "tenth": "10", "bangalore": "bengaluru", "bombay": "mumbai",
    "madras": "chennai", "calcutta": "kolkata", "gurgaon": "gurugram", "poona": "pune", "mysore": "mysuru",
    "trivandrum": "thiruvananthapuram", "baroda": "vadodara", "cochin": "kochi", "pondicherry": "puducherry",
    "vizag": "visakhapatnam", "benares": "varanasi", "banaras": "varanasi", "allahabad": "prayagraj",
    "belgaum": "belagavi",
}

#: Regions of one word to their codes, in cleaned form.
STATE_SINGLE = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co",
    "connecticut": "ct", "delaware": "de", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id",
    "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la",
    "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms",
    "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv", "ohio": "oh", "oklahoma": "ok",
    "oregon": "or", "pennsylvania": "pa", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt",
    "virginia": "va", "washington": "wa", "wisconsin": "wi", "wyoming": "wy", "maharashtra": "mh", "mharastr": "mh",
    "karnataka": "ka", "krnatk": "ka", "gujarat": "gj", "gujrat": "gj", "rajasthan": "rj", "rajsthan": "rj",
    "telangana": "tg", "telmgan": "tg", "kerala": "kl", "kerlm": "kl", "odisha": "od", "orissa": "od", "odisa": "od",
    "bihar": "br", "haryana": "hr", "hriyana": "hr", "punjab": "pb", "pmjab": "pb", "assam": "as", "asm": "as",
    "jharkhand": "jh", "jharkhmd": "jh", "chhattisgarh": "cg", "chttisgdh": "cg", "uttarakhand": "uk",
    "uttrakhmd": "uk", "goa": "ga", "gova": "ga", "delhi": "dl", "dilli": "dl", "pscimbng": "wb", "tmilnatu": "tn",
    "bengal": "bengal",
}

#: Regions of several words to their codes.
STATE_MULTI = {
    "north carolina": "nc", "south carolina": "sc", "north dakota": "nd", "south dakota": "sd", "new york": "ny",
    "new jersey": "nj", "new mexico": "nm", "new hampshire": "nh", "west virginia": "wv", "rhode island": "ri",
    "district of columbia": "dc", "tamil nadu": "tn", "west bengal": "wb", "uttar pradesh": "up", "uttr prdes": "up",
    "madhya pradesh": "mp", "mdhy prdes": "mp", "andhra pradesh": "ap", "andhr prdes": "ap", "amdhr prdes": "ap",
    "himachal pradesh": "hp", "jammu and kashmir": "jk", "new delhi": "dl",
}

#: Words of legal forms and articles, no part of a name's core.
LEGAL = (
    "private", "limited", "llp", "llc", "lc", "incorporated", "corporation", "company", "companies", "plc", "lp",
    "pllc", "pc", "pa", "gmbh", "ag", "bv", "nv", "opc", "sarl", "sas", "sasu", "sa", "eurl", "sci", "snc", "scp",
    "selarl", "eirl", "ei", "sca", "scs", "compagnie", "etablissements", "societe", "the", "and", "of", "de", "du",
    "des", "la", "le", "les", "l", "d", "et", "fils", "ltd",
)

#: Words of addresses that tell nothing.
ADDR_FILLER = (
    "near", "opposite", "behind", "beside", "next", "to", "the", "of", "at", "and", "in", "on", "no", "num", "number",
    "plot", "door", "flat", "hno", "h", "house", "shop", "unit", "suite", "floor", "apartment", "building", "ground",
    "de", "du", "des", "la", "le", "les", "l", "d", "et", "a", "an",
)

#: Phonetic folds, applied in this order.
PHONETIC = (
    ("ksh", "x"), ("ck", "k"), ("ph", "f"), ("sh", "s"), ("ch", "c"), ("th", "t"), ("dh", "d"), ("bh", "b"),
    ("kh", "k"), ("gh", "g"), ("jh", "j"), ("q", "k"), ("w", "v"), ("z", "j"), ("y", "i"), ("ee", "i"), ("oo", "u"),
    ("ou", "u"), ("v", "b"),
)

#: Long legal words that are recognised by sound among the last two words of a name.
LEGAL_BY_SOUND = ("private", "limited", "corporation", "incorporated")

#: Words that mark a number; a separator between them and a number becomes a blank.
MARKERS = ("no", "nos", "hno", "h", "plot", "door", "dr", "flat", "shop", "sy", "s", "unit", "apt", "ste", "fl", "pre", "room", "r", "gala", "khasra", "khata", "khewat")

#: Plain legal suffixes among the words added to a name.
PLAIN_LEGAL = (
    "co", "llc", "inc", "corp", "corporation", "company", "ltd", "limited", "pvt", "private", "llp", "pc", "lp",
    "pllc", "plc", "sarl", "sas", "sasu", "eurl", "gmbh", "incorporated", "pa", "sa",
)

#: Words added to a name that tell nothing.
GENERIC_ADDED = (
    "services", "service", "center", "centre", "partners", "group", "enterprises", "solutions", "trading", "society",
    "council", "global", "the", "m/s", "shri", "sri", "mr", "mrs", "sons", "and", "&", "&-",
)

#: Added words with a number of their own, from 1.
EXTRA_WORDS = (
    "co", "llc", "inc", "corp", "corporation", "company", "ltd", "limited", "pvt", "private", "llp", "pc", "lp", "&",
    "and", "[inc]", "[co]", "[llc]", "[corp]", "[ltd]", "[llp]", "(services)", "services", "center", "partners",
    "group", "the", "shri", "m/s", "sons", "enterprises", "trading", "society",
)

#: Channels of blocking keys: number, name, weight of a vote.
CHANNELS = (
    (0, "name_exact", 3.0), (1, "name_token", 1.0), (2, "name_prefix5", 1.0), (3, "name_phonetic_token", 0.6), (4, "name_bigram", 1.5),
    (5, "number", 1.0), (6, "alnum_code", 1.5), (7, "addr_bigram", 1.0), (8, "name_plus_number", 2.0), (9, "phonetic_exact", 2.0),
    (10, "addr_token", 0.4), (11, "number_plus_street", 2.0),
)
