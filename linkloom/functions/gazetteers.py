"""Fixed values of addresses: states, street words and their spellings, by country, as ``form: [spellings]``."""

from __future__ import annotations


def spellings(forms: dict[str, list[str]]) -> dict[str, str]:
    """Each spelling (and each form itself) with its form."""
    return {s: form for form, spelt in forms.items() for s in (*spelt, form)}


# Fixed values.
US_STATES = spellings({
        "al": ["alabama"], "ak": ["alaska"], "az": ["arizona"], "ar": ["arkansas"], "ca": ["california", "calif"], "co": ["colorado"], "ct": ["connecticut"],
        "de": ["delaware"], "fl": ["florida", "fla"], "ga": ["georgia"], "hi": ["hawaii"], "id": ["idaho"], "il": ["illinois", "ill"], "in": ["indiana"],
        "ia": ["iowa"], "ks": ["kansas"], "ky": ["kentucky"], "la": ["louisiana"], "me": ["maine"], "md": ["maryland"], "ma": ["massachusetts", "mass"],
        "mi": ["michigan"], "mn": ["minnesota"], "ms": ["mississippi"], "mo": ["missouri"], "mt": ["montana"], "ne": ["nebraska"], "nv": ["nevada"],
        "nh": ["new hampshire"], "nj": ["new jersey"], "nm": ["new mexico"], "ny": ["new york"], "nc": ["north carolina"], "nd": ["north dakota"],
        "oh": ["ohio"], "ok": ["oklahoma"], "or": ["oregon"], "pa": ["pennsylvania", "penn", "penna"], "ri": ["rhode island"], "sc": ["south carolina"],
        "sd": ["south dakota"], "tn": ["tennessee"], "tx": ["texas", "tex"], "ut": ["utah"], "vt": ["vermont"], "va": ["virginia"], "wa": ["washington", "wash"],
        "wv": ["west virginia"], "wi": ["wisconsin"], "wy": ["wyoming"], "dc": ["district of columbia", "washington dc", "washington d c", "d c"],
        "pr": ["puerto rico"], "gu": ["guam"], "vi": ["virgin islands"], "as": ["american samoa"], "mp": ["northern mariana islands"],
    })
INDIA_STATES = spellings({
        "andhra pradesh": ["ap", "andhra", "ఆంధ్రప్రదేశ్", "ఆంధ్ర ప్రదేశ్", "आंध्र प्रदेश"], "arunachal pradesh": ["ar", "arunachal", "अरुणाचल प्रदेश"],
        "assam": ["as", "অসম", "असम"], "bihar": ["br", "बिहार"], "chhattisgarh": ["cg", "ct", "chattisgarh", "chhatisgarh", "छत्तीसगढ़"], "goa": ["ga", "गोवा"],
        "gujarat": ["gj", "gujrat", "ગુજરાત", "गुजरात"], "haryana": ["hr", "हरियाणा"], "himachal pradesh": ["hp", "हिमाचल प्रदेश"],
        "jharkhand": ["jh", "झारखंड", "झारखण्ड"], "karnataka": ["ka", "ಕರ್ನಾಟಕ", "कर्नाटक"], "kerala": ["kl", "keralam", "കേരളം", "കേരള", "केरल"],
        "madhya pradesh": ["mp", "मध्य प्रदेश", "मध्यप्रदेश"], "maharashtra": ["mh", "maharastra", "महाराष्ट्र"], "manipur": ["mn", "मणिपुर"],
        "meghalaya": ["ml", "मेघालय"], "mizoram": ["mz", "मिजोरम"], "nagaland": ["nl", "नागालैंड"],
        "odisha": ["od", "or", "orissa", "ଓଡ଼ିଶା", "ଓଡିଶା", "ओडिशा", "उड़ीसा"], "punjab": ["pb", "ਪੰਜਾਬ", "पंजाब"], "rajasthan": ["rj", "राजस्थान"],
        "sikkim": ["sk", "सिक्किम"], "tamil nadu": ["tn", "tamilnadu", "தமிழ்நாடு", "தமிழ் நாடு", "तमिलनाडु", "तमिल नाडु"],
        "telangana": ["tg", "ts", "telengana", "తెలంగాణ", "तेलंगाना"], "tripura": ["tr", "त्रिपुरा"], "uttar pradesh": ["up", "उत्तर प्रदेश", "उत्तरप्रदेश"],
        "uttarakhand": ["uk", "ut", "uttaranchal", "उत्तराखंड", "उत्तराखण्ड"], "west bengal": ["wb", "পশ্চিমবঙ্গ", "পশ্চিম বঙ্গ", "पश्चिम बंगाल"],
        "delhi": ["dl", "nct of delhi", "nct delhi", "दिल्ली"], "jammu and kashmir": ["jk", "j and k", "jammu kashmir", "जम्मू और कश्मीर"],
        "ladakh": ["la", "लद्दाख"], "chandigarh": ["ch", "चंडीगढ़"], "puducherry": ["py", "pondicherry", "புதுச்சேரி"],
        "andaman and nicobar islands": ["an", "andaman and nicobar"],
        "dadra and nagar haveli and daman and diu": ["dn", "dd", "daman and diu", "dadra and nagar haveli"], "lakshadweep": ["ld"],
    })
FRANCE_REGIONS = spellings({
        "hauts de france": ["nord pas de calais", "picardie", "hdf"], "nouvelle aquitaine": ["aquitaine"], "pays de la loire": ["pays loire", "pdl"],
        "ile de france": ["idf", "iledefrance"], "auvergne rhone alpes": ["aura"], "bourgogne franche comte": [], "bretagne": [],
        "centre val de loire": ["centre"], "corse": [], "grand est": ["alsace", "lorraine"], "normandie": [], "occitanie": [],
        "provence alpes cote d azur": ["paca", "provence alpes cote dazur"],
    })
FRANCE_DEPARTMENTS = spellings({
        "hauts de france": ["nord", "pas de calais", "aisne", "oise", "somme"],
        "nouvelle aquitaine": ["gironde", "landes", "charente", "charente maritime", "correze", "creuse", "dordogne", "lot et garonne", "pyrenees atlantiques", "deux sevres", "vienne", "haute vienne"],
        "pays de la loire": ["loire atlantique", "maine et loire", "mayenne", "sarthe", "vendee"], "ile de france": ["paris"], "auvergne rhone alpes": ["rhone"],
        "provence alpes cote d azur": ["bouches du rhone", "alpes maritimes"], "occitanie": ["haute garonne", "herault"], "grand est": ["bas rhin"],
        "bretagne": ["ille et vilaine"], "normandie": ["seine maritime"],
    })
FRANCE_CITIES = spellings({
        "nord": ["lille", "roubaix", "tourcoing", "dunkerque"], "pas de calais": ["calais"],
        "gironde": ["bordeaux", "pessac", "merignac", "la teste de buch", "lege cap ferret"],
        "loire atlantique": ["nantes", "saint nazaire", "saint herblain", "pornic", "la baule escoublac"],
    })
INDIA_CITIES = spellings({
        "mumbai": ["bombay"], "kolkata": ["calcutta"], "chennai": ["madras"], "bangalore": ["bengaluru"], "gurgaon": ["gurugram"], "vadodara": ["baroda"],
        "pune": ["poona"], "thiruvananthapuram": ["trivandrum"], "kochi": ["cochin"], "mysore": ["mysuru"], "mangalore": ["mangaluru"],
        "allahabad": ["prayagraj"], "ahmedabad": ["ahmadabad"], "belgaum": ["belagavi"], "gulbarga": ["kalaburagi"], "visakhapatnam": ["vizag"],
        "varanasi": ["benares", "banaras"], "puducherry": ["pondy"], "kadapa": ["cuddapah"], "delhi": ["new delhi"],
    })
STREETS = {
    "us": spellings({
        "st": ["street", "str", "strt", "saint"], "rd": ["road"], "dr": ["drive", "drv"], "ave": ["avenue", "av", "aven", "avn"], "ln": ["lane"],
        "ct": ["court", "crt"], "blvd": ["boulevard", "boul", "blv"], "hwy": ["highway", "hiway"], "pkwy": ["parkway", "pky", "pkway"], "pl": ["place"],
        "ter": ["terrace", "terr"], "cir": ["circle", "circ", "crcl"], "way": ["wy"], "trl": ["trail"], "sq": ["square", "sqr"], "rte": ["route"],
        "pike": ["pk"], "expy": ["expressway"], "fwy": ["freeway"], "aly": ["alley"], "loop": ["lp"], "xing": ["crossing"], "plz": ["plaza"], "cv": ["cove"],
        "pt": ["point"], "hts": ["heights"], "mt": ["mount", "mtn", "mountain"], "ft": ["fort"], "n": ["north"], "s": ["south"], "e": ["east"], "w": ["west"],
        "ne": ["northeast"], "nw": ["northwest"], "se": ["southeast"], "sw": ["southwest"],
        "unit": ["apt", "apartment", "suite", "ste", "rm", "room", "bldg", "building", "cond", "spc", "space", "trlr", "lot", "dept", "office", "ofc"],
        "fl": ["floor", "flr"],
    }),
    "india": spellings({
        "rd": ["road"], "st": ["street", "str"], "near": ["nr", "nea"], "opp": ["opposite", "oppo"], "behind": ["bh", "bhd"], "no": ["number", "num", "nos"],
        "hno": ["h no", "house no", "hn", "h"], "dno": ["d no", "door no", "dr no"], "plot": ["plot no", "pl no", "plt"], "flat": ["flat no"],
        "shop": ["shop no"], "fl": ["floor", "flr"], "gf": ["ground floor", "grd floor", "g f"], "ff": ["first floor", "1st floor", "ist floor"],
        "sf": ["second floor", "2nd floor", "iind floor"], "tf": ["third floor", "3rd floor", "iiird floor"], "1st": ["first", "ist"],
        "2nd": ["second", "iind", "iird"], "3rd": ["third", "iiird"], "4th": ["fourth", "ivth"], "5th": ["fifth", "vth"], "nagar": ["ngr"], "colony": ["col"],
        "sector": ["sec", "sect"], "marg": [], "cross": ["crs"], "main": [], "layout": ["lyt"], "extn": ["extension", "ext"],
        "apt": ["apartment", "apartments", "apts", "appt"], "bldg": ["building"], "soc": ["society"], "estate": ["est"], "indl": ["industrial", "ind"],
        "po": ["post office", "p o", "post"], "dist": ["district", "distt"], "tal": ["taluka", "taluk", "tq"], "vill": ["village", "vpo", "vil"],
        "ps": ["police station"], "co": ["c o", "care of"], "so": ["s o", "son of"], "wo": ["w o", "wife of"], "n": ["north"], "s": ["south"], "e": ["east"],
        "w": ["west"],
    }),
    "france": spellings({
        "rue": ["r", "ru"], "av": ["avenue", "ave", "aven"], "bd": ["boulevard", "blvd", "boul", "bld"], "pl": ["place", "plc"], "imp": ["impasse"],
        "ch": ["chemin", "chem", "che", "chmn"], "all": ["allee", "allees", "alle", "al"], "sq": ["square"], "rte": ["route", "rt"], "quai": ["qu", "q", "qua"],
        "crs": ["cours"], "fg": ["faubourg", "fbg"], "cour": [], "cite": ["cit"], "res": ["residence", "resid"], "pass": ["passage", "psg"],
        "lot": ["lotissement", "lotis"], "chau": ["chaussee"], "sen": ["sentier"], "apt": ["appartement", "appart", "appt"], "prom": ["promenade"],
        "rpt": ["rond point"], "za": ["zone artisanale"], "zi": ["zone industrielle"], "zac": ["zone d amenagement concerte"], "hameau": ["ham"],
        "lieu dit": ["lieudit", "ld"], "saint": ["st"], "sainte": ["ste"], "grande": ["gde"], "general": ["gal", "gen"], "docteur": ["dr"], "marechal": ["mal"],
        "president": ["pdt", "pres"], "bat": ["batiment", "bt"], "etage": ["et", "etg"], "bp": ["boite postale", "b p"], "cs": ["c s"],
    }),
}
AMBIGUOUS = set("dr ste ch r q h e w n s et al ld rt ind bh bt mg post lot".split())
TYPES = {
    "us": set("st rd dr ave ln ct blvd hwy pkwy pl ter cir way trl sq rte pike expy fwy aly loop xing plz cv".split()),
    "india": set("rd st marg cross main nagar colony sector layout".split()),
    "france": set("rue av bd pl imp ch all sq rte quai crs fg cour cite res pass lot chau sen prom rpt hameau".split()),
}
UNITS = set("unit fl apt bldg flat shop gf ff sf tf bat etage office".split())
DESIGNATORS = set("hno plot dno pmb flat shop no unit fl apt office kh khasra sno survey gali ward block bp cs sector phase khno ps".split())
PREMISES = ("hno", "dno", "plot", "no")
FLOORS = set("gf ff sf tf fl etage rdc lgf ugf".split())
SMALL_WORDS = set("de du des la le les d l au aux et en sur sous".split())
NULL_WORDS = {"null", "none", "nil", "nan", "n/a", "n a", "<null>", "na", "n.a.", "unknown", "not available", "-", "--", "null null"}
