"""Default lexicons, as plain values.

Every operator takes its lexicon as an argument; these are only the defaults.
A lexicon kept in a table goes through :func:`rows_of`, which checks its size
before anything reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Place names by continent. Terms of three letters or fewer match
# as whole words, longer ones anywhere in the text.
# ---------------------------------------------------------------------------
CONTINENT_TERMS: dict[str, list[str]] = {
    "Americas": [
        "united states", "usa", "us", "new york", "washington dc", "washington d.c.",
        "los angeles", "san francisco", "chicago", "houston", "toronto", "mexico city",
        "são paulo", "sao paulo", "buenos aires", "calgary", "austin", "portland",
        "panama city", "san jose", "palo alto", "mountain view", "seattle", "boston",
        "canada", "mexico", "brazil", "argentina", "chile", "colombia", "peru",
        "venezuela", "ecuador", "bolivia", "paraguay", "uruguay", "guyana", "suriname",
        "french guiana", "cuba", "jamaica", "haiti", "dominican republic", "puerto rico",
        "guatemala", "honduras", "el salvador", "nicaragua", "costa rica", "panama",
    ],
    "Europe": [
        "united kingdom", "uk", "britain", "london", "paris", "berlin", "brussels",
        "amsterdam", "madrid", "rome", "moscow", "warsaw", "istanbul", "kyiv", "kiev",
        "gibraltar", "copenhagen", "munich", "barcelona", "aberdeen", "stavanger",
        "france", "germany", "italy", "spain", "poland", "russia", "ukraine", "turkey",
        "netherlands", "belgium", "denmark", "sweden", "norway", "finland",
        "switzerland", "austria", "czech republic", "hungary", "romania", "bulgaria",
        "greece", "portugal", "ireland", "european union", "eu",
    ],
    "Asia": [
        "china", "japan", "india", "south korea", "singapore", "thailand", "indonesia",
        "philippines", "uae", "israel", "tokyo", "beijing", "shanghai", "hong kong",
        "seoul", "mumbai", "delhi", "bangkok", "jakarta", "manila", "dubai", "tel aviv",
        "bangalore", "shenzhen", "baku", "doha", "kuwait city", "gaza", "gaza city",
        "ramallah", "jerusalem", "damascus", "beirut", "palestine", "west bank", "hamas",
        "south asia", "southeast asia", "middle east", "asean", "gulf states",
        "persian gulf", "south china sea", "east asia", "central asia",
    ],
    "Africa": [
        "egypt", "nigeria", "south africa", "kenya", "morocco", "ethiopia", "cairo",
        "lagos", "johannesburg", "nairobi", "casablanca", "addis ababa", "north africa",
        "sub-saharan africa", "west africa", "east africa", "southern africa",
    ],
    "Oceania": [
        "australia", "new zealand", "sydney", "melbourne", "auckland", "wellington",
        "pacific islands",
    ],
    "Global": [
        "global", "worldwide", "international", "world", "earth", "planet", "suez",
        "suez canal",
    ],
}

# ---------------------------------------------------------------------------
# Topic terms. A topic fires when a matched news keyword is one
# of its terms.
# ---------------------------------------------------------------------------
TOPIC_TERMS: dict[str, list[str]] = {
    "energy": [
        "energy", "electricity", "renewable energy", "solar power", "wind energy",
        "battery storage", "smart grid", "microgrid", "electric vehicles",
        "capacity market", "demand response", "carbon pricing", "carbon tax",
        "feed-in tariff", "grid reliability", "transmission planning",
        "levelized cost of energy", "power purchase agreement", "green bond",
        "esg investment", "coal", "rare earth minerals", "lithium", "nuclear", "gas",
        "oil", "supply chain",
    ],
    "ai": [
        "artificial intelligence", "ai", "machine learning", "ml", "neural network",
        "deep learning", "cybersecurity", "digital twin", "predictive analytics",
    ],
    "blockchain": [
        "blockchain", "cryptocurrency", "bitcoin", "ethereum", "crypto", "defi", "web3",
    ],
    "insurance": [
        "insurance", "catastrophe modeling", "exposure data", "reinsurance",
        "underwriting", "climate risk",
    ],
    "geopolitics": [
        "war", "civil unrest", "protest", "climate risk", "conflict", "diplomacy",
        "sanctions", "trade war", "military", "defense", "security", "terrorism",
        "refugees", "migration",
    ],
}

# ---------------------------------------------------------------------------
# News keywords, in order. "climate risk" stands there twice and
# is reported twice.
# ---------------------------------------------------------------------------
NEWS_KEYWORDS: list[str] = [
    "energy", "electricity", "blockchain", "artificial intelligence", "AI", "insurance",
    "renewable energy", "solar power", "wind energy", "battery storage", "smart grid",
    "microgrid", "electric vehicles", "capacity market", "demand response",
    "carbon pricing", "carbon tax", "feed-in tariff", "grid reliability",
    "transmission planning", "levelized cost of energy", "power purchase agreement",
    "green bond", "ESG investment", "coal", "rare earth minerals", "lithium", "nuclear",
    "gas", "oil", "supply chain", "catastrophe modeling", "exposure data", "reinsurance",
    "underwriting", "climate risk", "war", "civil unrest", "protest", "climate risk",
    "cybersecurity", "digital twin", "predictive analytics",
    "Federal Energy Regulatory Commission", "FERC",
    "North American Electric Reliability Corporation", "NERC", "Department of Energy",
    "DOE", "Environmental Protection Agency", "EPA",
    "National Renewable Energy Laboratory", "NREL", "International Energy Agency", "IEA",
    "Commodity Futures Trading Commission", "CFTC",
    "Insurance Regulatory and Development Authority", "IRDAI", "Standard & Poor's",
    "Moody's", "Fitch", "Bloomberg",
]

# ---------------------------------------------------------------------------
# Country terms by how they match. "word": whole word; "start":
# must start a word; "anywhere": substring.
# ---------------------------------------------------------------------------
COUNTRY_TERMS: dict[str, dict[str, list[str]]] = {
    "United States": {
        "word": ["US", "USA", "America", "American"],
        "start": ["U.S."],
        "anywhere": ["United States", "Washington DC", "Washington D.C"],
    },
    "United Kingdom": {
        "word": ["UK", "Britain", "British", "England", "Scotland", "Wales"],
        "start": ["U.K."],
        "anywhere": ["United Kingdom"],
    },
    "China": {"word": ["China", "Chinese", "Beijing", "Xi Jinping"]},
    "Russia": {"word": ["Russia", "Russian", "Moscow", "Putin", "Kremlin"]},
    "Ukraine": {"word": ["Ukraine", "Ukrainian", "Kyiv", "Zelensky"]},
    "Israel": {"word": ["Israel", "Israeli", "Netanyahu", "Tel Aviv", "IDF"]},
    "Palestine": {"word": ["Palestine", "Palestinian", "Gaza", "West Bank", "Hamas"]},
    "Iran": {"word": ["Iran", "Iranian", "Tehran", "Khamenei"]},
    "North Korea": {"word": ["North Korea", "NKorea", "Pyongyang"], "start": ["Kim Jong"]},
    "South Korea": {"word": ["South Korea", "SKorea", "Seoul"]},
    "Taiwan": {"word": ["Taiwan", "Taiwanese", "Taipei"]},
    "Japan": {"word": ["Japan", "Japanese", "Tokyo"]},
    "Germany": {"word": ["Germany", "German", "Berlin", "Scholz"]},
    "France": {"word": ["France", "French", "Paris", "Macron"]},
    "Italy": {"word": ["Italy", "Italian", "Rome", "Meloni"]},
    "Spain": {"word": ["Spain", "Spanish", "Madrid"]},
    "Poland": {"word": ["Poland", "Polish", "Warsaw"]},
    "Brazil": {"word": ["Brazil", "Brazilian", "Brasilia", "Lula", "Bolsonaro"]},
    "Mexico": {"word": ["Mexico", "Mexican", "Mexico City"]},
    "Canada": {"word": ["Canada", "Canadian", "Ottawa", "Trudeau"]},
    "Argentina": {"word": ["Argentina", "Argentine", "Buenos Aires", "Milei"]},
    "Australia": {"word": ["Australia", "Australian", "Canberra", "Sydney"]},
    "India": {"word": ["India", "Indian", "New Delhi", "Modi"]},
    "Pakistan": {"word": ["Pakistan", "Pakistani", "Islamabad"]},
    "Saudi Arabia": {"word": ["Saudi Arabia", "Saudi", "Riyadh", "MBS"]},
    "Turkey": {"word": ["Turkey", "Turkish", "Ankara", "Erdogan"]},
    "Egypt": {"word": ["Egypt", "Egyptian", "Cairo"]},
    "South Africa": {"word": ["South Africa", "South African", "Pretoria", "Johannesburg"]},
    "Nigeria": {"word": ["Nigeria", "Nigerian", "Abuja", "Lagos"]},
    "Venezuela": {"word": ["Venezuela", "Venezuelan", "Caracas", "Maduro"]},
    "Syria": {"word": ["Syria", "Syrian", "Damascus", "Assad"]},
    "Afghanistan": {"word": ["Afghanistan", "Afghan", "Kabul", "Taliban"]},
    "Iraq": {"word": ["Iraq", "Iraqi", "Baghdad"]},
    "Lebanon": {"word": ["Lebanon", "Lebanese", "Beirut", "Hezbollah"]},
    "Yemen": {"word": ["Yemen", "Yemeni", "Houthi"]},
    "European Union": {"word": ["European Union", "EU", "Brussels"]},
}

# ---------------------------------------------------------------------------
# Political terms (whole words; "eu " wants a word character
# after its space) and category fragments.
# ---------------------------------------------------------------------------
POLITICAL_TERMS: list[str] = [
    "election", "president", "presidential", "congress", "senate", "governor",
    "parliament", "prime minister", "vote", "voter", "republican", "democrat",
    "conservative", "liberal", "trump", "biden", "desantis", "harris", "pence", "newsom",
    "war", "conflict", "invasion", "military", "nato", "sanctions", "tariff",
    "trade war", "treaty", "diplomacy", "nuclear", "legislation", "bill", "law",
    "policy", "regulation", "impeachment", "supreme court", "federal reserve",
    "fed rate", "putin", "zelensky", "xi jinping", "netanyahu", "eu ", "european union",
]
POLITICAL_CATEGORIES: list[str] = ["politics", "election", "government", "current-affairs"]

# Hosts whose feeds carry legislation.
LEGISLATIVE_DOMAINS: list[str] = [
    "congress.gov", "bills.parliament.uk", "eur-lex.europa.eu", "aph.gov.au",
    "camara.leg.br", "senado.leg.br", "pmg.org.za",
]

# Source-health terms, matched as substrings.
RELEVANCE_TERMS: list[str] = [
    "energy", "oil", "gas", "renewable", "solar", "wind", "nuclear", "coal",
    "artificial intelligence", "ai", "machine learning", "blockchain", "cryptocurrency",
    "bitcoin", "ethereum", "fintech", "technology", "innovation",
]
REGION_RELEVANCE_TERMS: dict[str, list[str]] = {
    "Africa": [
        "africa", "african", "nigeria", "south africa", "kenya", "egypt", "morocco",
        "ghana", "ethiopia",
    ],
    "Latin America": [
        "latin america", "brazil", "mexico", "argentina", "chile", "colombia", "peru",
        "venezuela", "uruguay",
    ],
    "MENA": [
        "middle east", "gulf", "saudi", "uae", "qatar", "kuwait", "bahrain", "oman",
        "jordan", "lebanon", "israel", "palestine",
    ],
}
BLOCKED_PAGE_TERMS: list[str] = [
    "cloudflare", "captcha", "access denied", "blocked", "forbidden", "rate limit",
    "too many requests", "please wait", "verifying", "security check", "robot",
    "bot detection",
]

# URL fragments of the article-link test.
SKIP_URL_PARTS: list[str] = [
    "/tag/", "/category/", "/author/", "/search/", "/page/", "/rss", "/feed", "/api/",
    "/static/", "/css/", "/js/", "/images/", "/img/", "/video/", "/audio/",
]
ARTICLE_URL_PARTS: list[str] = [
    "/article/", "/news/", "/story/", "/post/", "/entry/", "/2024/", "/2025/",
    "/january/", "/february/", "/march/", "/april/", "/may/", "/june/", "/july/",
    "/august/", "/september/", "/october/", "/november/", "/december/",
]

# Terms of region detection (whole words, last entry wins). Other
# gazetteers are passed in as a table; see `region_lexicon`.
REGION_TERMS: list[tuple[str, str]] = [
    ("africa", "Africa"), ("african", "Africa"), ("nigeria", "Africa"), ("lagos", "Africa"), ("abuja", "Africa"),
    ("kano", "Africa"), ("south africa", "Africa"), ("johannesburg", "Africa"), ("cape town", "Africa"),
    ("durban", "Africa"), ("kenya", "Africa"), ("nairobi", "Africa"), ("mombasa", "Africa"), ("egypt", "Africa"),
    ("cairo", "Africa"), ("alexandria", "Africa"), ("morocco", "Africa"), ("casablanca", "Africa"), ("rabat", "Africa"),
    ("ghana", "Africa"), ("accra", "Africa"), ("kumasi", "Africa"), ("ethiopia", "Africa"), ("addis ababa", "Africa"),
    ("tanzania", "Africa"), ("dar es salaam", "Africa"), ("uganda", "Africa"), ("kampala", "Africa"),
    ("zimbabwe", "Africa"), ("harare", "Africa"), ("zambia", "Africa"), ("lusaka", "Africa"), ("botswana", "Africa"),
    ("gaborone", "Africa"), ("namibia", "Africa"), ("windhoek", "Africa"), ("senegal", "Africa"), ("dakar", "Africa"),
    ("ivory coast", "Africa"), ("abidjan", "Africa"), ("mali", "Africa"), ("bamako", "Africa"),
    ("burkina faso", "Africa"), ("ouagadougou", "Africa"), ("niger", "Africa"), ("niamey", "Africa"),
    ("chad", "Africa"), ("ndjamena", "Africa"), ("cameroon", "Africa"), ("yaounde", "Africa"),
    ("central african republic", "Africa"), ("bangui", "Africa"), ("democratic republic of congo", "Africa"),
    ("kinshasa", "Africa"), ("republic of congo", "Africa"), ("brazzaville", "Africa"), ("gabon", "Africa"),
    ("libreville", "Africa"), ("equatorial guinea", "Africa"), ("malabo", "Africa"),
    ("sao tome and principe", "Africa"), ("sao tome", "Africa"), ("angola", "Africa"), ("luanda", "Africa"),
    ("mozambique", "Africa"), ("maputo", "Africa"), ("madagascar", "Africa"), ("antananarivo", "Africa"),
    ("mauritius", "Africa"), ("port louis", "Africa"), ("seychelles", "Africa"), ("victoria", "Africa"),
    ("comoros", "Africa"), ("moroni", "Africa"), ("djibouti", "Africa"), ("djibouti city", "Africa"),
    ("somalia", "Africa"), ("mogadishu", "Africa"), ("eritrea", "Africa"), ("asmara", "Africa"), ("sudan", "Africa"),
    ("khartoum", "Africa"), ("south sudan", "Africa"), ("juba", "Africa"), ("libya", "Africa"), ("tripoli", "Africa"),
    ("tunisia", "Africa"), ("tunis", "Africa"), ("algeria", "Africa"), ("algiers", "Africa"), ("mauritania", "Africa"),
    ("nouakchott", "Africa"), ("western sahara", "Africa"), ("laayoune", "Africa"), ("lesotho", "Africa"),
    ("maseru", "Africa"), ("eswatini", "Africa"), ("mbabane", "Africa"), ("malawi", "Africa"), ("lilongwe", "Africa"),
    ("rwanda", "Africa"), ("kigali", "Africa"), ("burundi", "Africa"), ("bujumbura", "Africa"),
    ("sierra leone", "Africa"), ("freetown", "Africa"), ("liberia", "Africa"), ("monrovia", "Africa"),
    ("guinea", "Africa"), ("conakry", "Africa"), ("guinea-bissau", "Africa"), ("bissau", "Africa"),
    ("gambia", "Africa"), ("banjul", "Africa"), ("cape verde", "Africa"), ("praia", "Africa"), ("sao tome", "Africa"),
    ("sao tome and principe", "Africa"), ("latin america", "Latin America"), ("south america", "Latin America"),
    ("central america", "Latin America"), ("brazil", "Latin America"), ("brasil", "Latin America"),
    ("sao paulo", "Latin America"), ("rio de janeiro", "Latin America"), ("brasilia", "Latin America"),
    ("belo horizonte", "Latin America"), ("salvador", "Latin America"), ("fortaleza", "Latin America"),
    ("recife", "Latin America"), ("porto alegre", "Latin America"), ("curitiba", "Latin America"),
    ("manaus", "Latin America"), ("mexico", "Latin America"), ("mexico city", "Latin America"),
    ("guadalajara", "Latin America"), ("monterrey", "Latin America"), ("puebla", "Latin America"),
    ("tijuana", "Latin America"), ("argentina", "Latin America"), ("buenos aires", "Latin America"),
    ("cordoba", "Latin America"), ("rosario", "Latin America"), ("mendoza", "Latin America"),
    ("la plata", "Latin America"), ("chile", "Latin America"), ("santiago", "Latin America"),
    ("valparaiso", "Latin America"), ("concepcion", "Latin America"), ("colombia", "Latin America"),
    ("bogota", "Latin America"), ("medellin", "Latin America"), ("cali", "Latin America"),
    ("barranquilla", "Latin America"), ("cartagena", "Latin America"), ("peru", "Latin America"),
    ("lima", "Latin America"), ("arequipa", "Latin America"), ("trujillo", "Latin America"),
    ("venezuela", "Latin America"), ("caracas", "Latin America"), ("maracaibo", "Latin America"),
    ("valencia", "Latin America"), ("ecuador", "Latin America"), ("quito", "Latin America"),
    ("guayaquil", "Latin America"), ("cuenca", "Latin America"), ("bolivia", "Latin America"),
    ("la paz", "Latin America"), ("santa cruz", "Latin America"), ("cochabamba", "Latin America"),
    ("paraguay", "Latin America"), ("asuncion", "Latin America"), ("uruguay", "Latin America"),
    ("montevideo", "Latin America"), ("guyana", "Latin America"), ("georgetown", "Latin America"),
    ("suriname", "Latin America"), ("paramaribo", "Latin America"), ("french guiana", "Latin America"),
    ("cayenne", "Latin America"), ("guatemala", "Latin America"), ("guatemala city", "Latin America"),
    ("honduras", "Latin America"), ("tegucigalpa", "Latin America"), ("el salvador", "Latin America"),
    ("san salvador", "Latin America"), ("nicaragua", "Latin America"), ("managua", "Latin America"),
    ("costa rica", "Latin America"), ("san jose", "Latin America"), ("panama", "Latin America"),
    ("panama city", "Latin America"), ("belize", "Latin America"), ("belmopan", "Latin America"),
    ("cuba", "Latin America"), ("havana", "Latin America"), ("jamaica", "Latin America"), ("kingston", "Latin America"),
    ("haiti", "Latin America"), ("port-au-prince", "Latin America"), ("dominican republic", "Latin America"),
    ("santo domingo", "Latin America"), ("puerto rico", "Latin America"), ("san juan", "Latin America"),
    ("trinidad and tobago", "Latin America"), ("port of spain", "Latin America"), ("barbados", "Latin America"),
    ("bridgetown", "Latin America"), ("bahamas", "Latin America"), ("nassau", "Latin America"),
    ("dominica", "Latin America"), ("roseau", "Latin America"), ("grenada", "Latin America"),
    ("saint georges", "Latin America"), ("saint lucia", "Latin America"), ("castries", "Latin America"),
    ("saint vincent and the grenadines", "Latin America"), ("kingstown", "Latin America"),
    ("antigua and barbuda", "Latin America"), ("saint johns", "Latin America"),
    ("saint kitts and nevis", "Latin America"), ("basseterre", "Latin America"), ("mena", "MENA"),
    ("middle east", "MENA"), ("gulf", "MENA"), ("saudi arabia", "MENA"), ("saudi", "MENA"), ("riyadh", "MENA"),
    ("jeddah", "MENA"), ("mecca", "MENA"), ("medina", "MENA"), ("dammam", "MENA"), ("taif", "MENA"), ("tabuk", "MENA"),
    ("united arab emirates", "MENA"), ("uae", "MENA"), ("dubai", "MENA"), ("abu dhabi", "MENA"), ("sharjah", "MENA"),
    ("ajman", "MENA"), ("ras al khaimah", "MENA"), ("fujairah", "MENA"), ("qatar", "MENA"), ("doha", "MENA"),
    ("al rayyan", "MENA"), ("kuwait", "MENA"), ("kuwait city", "MENA"), ("al ahmadi", "MENA"), ("bahrain", "MENA"),
    ("manama", "MENA"), ("muharraq", "MENA"), ("oman", "MENA"), ("muscat", "MENA"), ("salalah", "MENA"),
    ("yemen", "MENA"), ("sanaa", "MENA"), ("aden", "MENA"), ("iraq", "MENA"), ("baghdad", "MENA"), ("basra", "MENA"),
    ("mosul", "MENA"), ("iran", "MENA"), ("tehran", "MENA"), ("mashhad", "MENA"), ("isfahan", "MENA"),
    ("syria", "MENA"), ("damascus", "MENA"), ("aleppo", "MENA"), ("lebanon", "MENA"), ("beirut", "MENA"),
    ("tripoli", "MENA"), ("jordan", "MENA"), ("amman", "MENA"), ("zarqa", "MENA"), ("israel", "MENA"),
    ("jerusalem", "MENA"), ("tel aviv", "MENA"), ("haifa", "MENA"), ("beersheba", "MENA"), ("netanya", "MENA"),
    ("palestine", "MENA"), ("gaza", "MENA"), ("ramallah", "MENA"), ("west bank", "MENA"), ("east jerusalem", "MENA"),
    ("turkey", "MENA"), ("ankara", "MENA"), ("istanbul", "MENA"), ("izmir", "MENA"), ("bursa", "MENA"),
    ("antalya", "MENA"), ("cyprus", "MENA"), ("nicosia", "MENA"), ("limassol", "MENA"), ("egypt", "MENA"),
    ("cairo", "MENA"), ("alexandria", "MENA"), ("giza", "MENA"), ("luxor", "MENA"), ("aswan", "MENA"),
    ("libya", "MENA"), ("tripoli", "MENA"), ("benghazi", "MENA"), ("tunisia", "MENA"), ("tunis", "MENA"),
    ("sfax", "MENA"), ("algeria", "MENA"), ("algiers", "MENA"), ("oran", "MENA"), ("morocco", "MENA"),
    ("casablanca", "MENA"), ("rabat", "MENA"), ("fes", "MENA"), ("marrakech", "MENA"), ("agadir", "MENA"),
    ("mauritania", "MENA"), ("nouakchott", "MENA"), ("nouadhibou", "MENA"), ("western sahara", "MENA"),
    ("laayoune", "MENA"), ("dakhla", "MENA"), ("sudan", "MENA"), ("khartoum", "MENA"), ("port sudan", "MENA"),
    ("south sudan", "MENA"), ("juba", "MENA"), ("wau", "MENA"), ("ethiopia", "MENA"), ("addis ababa", "MENA"),
    ("dire dawa", "MENA"), ("eritrea", "MENA"), ("asmara", "MENA"), ("massawa", "MENA"), ("djibouti", "MENA"),
    ("djibouti city", "MENA"), ("ali sabieh", "MENA"), ("somalia", "MENA"), ("mogadishu", "MENA"), ("hargeisa", "MENA"),
    ("somaliland", "MENA"), ("berbera", "MENA"),
]


def rows_of(lexicon: DataFrame, max_rows: int | None = None) -> list[tuple]:
    """A lexicon table as rows on the driver; with `max_rows`, refuses a larger one."""
    rows = (lexicon if max_rows is None else lexicon.limit(max_rows + 1)).collect()
    if max_rows is not None and len(rows) > max_rows:
        raise ValueError(
            f"lexicon has more than {max_rows} rows; use operators.joins.explode_matches instead"
        )
    return [tuple(row) for row in rows]


def region_lexicon(entries: list[tuple[str, str]] | DataFrame) -> dict[str, list[str]]:
    """Ordered (term, region) entries as region -> terms; a later entry overrides an earlier one.

    A table says its order in a column `position`; which entry of a term is the last is decided before any row
    reaches the driver.
    """
    if isinstance(entries, DataFrame):
        last_entries = entries.groupBy(F.lower("term").alias("term")).agg(
            F.max_by("region", "position").alias("region"), F.max("position").alias("position")
        )
        entries = [row[:2] for row in sorted(rows_of(last_entries), key=lambda row: row[2])]
    last: dict[str, str] = {}
    for term, region in entries:
        last[term.lower()] = region
    regions: dict[str, list[str]] = {}
    for term, region in last.items():
        regions.setdefault(region, []).append(term)
    return regions
