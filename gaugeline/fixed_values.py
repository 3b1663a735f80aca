"""Fixed values.

Everything in this file is data that must be exactly what it is for results to
be right: seed rows, word lists, weights, sizes, patterns and formats.
"""

# --- Seed rows -------------------------------------------------------------

SEED_COUNTRY_ROWS = [
    ("VNM", "Vietnam", "East Asia & Pacific", "Lower-middle income", "true", "true"),
    ("THA", "Thailand", "East Asia & Pacific", "Upper-middle income", "true", "false"),
    ("IDN", "Indonesia", "East Asia & Pacific", "Upper-middle income", "true", "false"),
    ("PHL", "Philippines", "East Asia & Pacific", "Lower-middle income", "true", "false"),
    ("MYS", "Malaysia", "East Asia & Pacific", "Upper-middle income", "true", "false"),
    ("SGP", "Singapore", "East Asia & Pacific", "High income", "true", "false"),
    ("CHN", "China", "East Asia & Pacific", "Upper-middle income", "false", "false"),
    ("USA", "United States", "North America", "High income", "false", "false"),
    ("JPN", "Japan", "East Asia & Pacific", "High income", "false", "false"),
    ("KOR", "Korea Rep.", "East Asia & Pacific", "High income", "false", "false"),
]

SEED_INDICATOR_ROWS = [
    ("NY.GDP.MKTP.CD", "GDP (current USD)", "gdp", "USD", "annual", "Gross Domestic Product at current prices in US dollars"),
    ("NY.GDP.MKTP.KD.ZG", "GDP growth (annual %)", "gdp", "%", "annual", "Annual percentage growth rate of GDP at market prices"),
    ("NY.GDP.PCAP.CD", "GDP per capita (current USD)", "gdp", "USD", "annual", "GDP per capita at current prices in US dollars"),
    ("NY.GNP.PCAP.CD", "GNI per capita (current USD)", "gdp", "USD", "annual", "Gross National Income per capita at current prices"),
    ("FP.CPI.TOTL.ZG", "Inflation CPI (annual %)", "prices", "%", "annual", "Consumer price index - annual percentage change"),
    ("FP.CPI.TOTL", "Consumer Price Index (2010=100)", "prices", "Index", "annual", "Consumer price index reflects changes in cost to average consumer"),
    ("SL.UEM.TOTL.ZS", "Unemployment rate (%)", "labor", "%", "annual", "Unemployment as percentage of total labor force"),
    ("SL.TLF.TOTL.IN", "Labor force total", "labor", "People", "annual", "Total labor force"),
    ("BX.KLT.DINV.WD.GD.ZS", "Foreign direct investment (% of GDP)", "investment", "%", "annual", "Net inflows of foreign direct investment as % of GDP"),
    ("NE.EXP.GNFS.ZS", "Exports (% of GDP)", "trade", "%", "annual", "Exports of goods and services as percentage of GDP"),
    ("NE.IMP.GNFS.ZS", "Imports (% of GDP)", "trade", "%", "annual", "Imports of goods and services as percentage of GDP"),
    ("BN.CAB.XOKA.GD.ZS", "Current account balance (% of GDP)", "trade", "%", "annual", "Current account balance as percentage of GDP"),
    ("GC.DOD.TOTL.GD.ZS", "Government debt (% of GDP)", "rates", "%", "annual", "Central government debt as percentage of GDP"),
    ("FI.RES.TOTL.CD", "Total reserves (current USD)", "rates", "USD", "annual", "Total reserves including gold at current USD"),
    ("PA.NUS.FCRF", "Official exchange rate (LCU per USD)", "rates", "LCU", "annual", "Official exchange rate in local currency units per USD"),
    ("SP.POP.TOTL", "Population total", "structure", "People", "annual", "Total population"),
    ("SP.POP.GROW", "Population growth (annual %)", "structure", "%", "annual", "Annual population growth rate"),
    ("SI.POV.GINI", "GINI index", "structure", "Index", "sparse", "Gini index measures income inequality (0=perfect equality 100=perfect inequality)"),
    ("SE.PRM.ENRR", "Primary school enrollment (%)", "structure", "%", "sparse", "Gross primary school enrollment ratio"),
    ("IT.NET.USER.ZS", "Internet users (% of population)", "technology", "%", "annual", "Percentage of population using the internet"),
    ("EG.USE.ELEC.KH.PC", "Electric power consumption (kWh per capita)", "technology", "kWh", "annual", "Electric power consumption per capita"),
    ("EN.ATM.CO2E.KT", "CO2 emissions (kt)", "technology", "kt", "annual", "Carbon dioxide emissions in kilotons"),
    ("NV.AGR.TOTL.ZS", "Agriculture value added (% of GDP)", "structure", "%", "annual", "Agriculture as percentage of GDP"),
    ("NV.IND.TOTL.ZS", "Industry value added (% of GDP)", "structure", "%", "annual", "Industry as percentage of GDP"),
    ("NV.SRV.TOTL.ZS", "Services value added (% of GDP)", "structure", "%", "annual", "Services as percentage of GDP"),
    ("LP.LPI.OVRL.XQ", "Logistics Performance Index", "structure", "Index", "sparse", "Logistics Performance Index overall score (1=low to 5=high)"),
    ("TM.TAX.MRCH.SM.AR", "Tariff rate (%)", "trade", "%", "sparse", "Most Favored Nation simple mean tariff rate"),
    ("IT.CEL.SETS.P2", "Mobile cellular subscriptions (per 100 people)", "technology", "per 100", "annual", "Mobile cellular subscriptions per 100 people"),
    ("IT.NET.BBND.P2", "Fixed broadband subscriptions (per 100 people)", "technology", "per 100", "annual", "Fixed broadband subscriptions per 100 people"),
    ("GB.XPD.RSDV.GD.ZS", "R&D expenditure (% of GDP)", "technology", "%", "sparse", "Research and development expenditure as percentage of GDP"),
    ("SL.TLF.CACT.FE.ZS", "Female labor force participation (%)", "labor", "%", "annual", "Female labor force participation rate"),
    ("ST.INT.RCPT.CD", "International tourism receipts (current USD)", "trade", "USD", "sparse", "International inbound tourism receipts in current USD"),
]

SOURCE_SYSTEM = "world_bank"
DOCUMENT_SOURCE = "world_bank_docs"

CALENDAR_START = "1950-01-01"
CALENDAR_END = "2030-12-31"

# --- Accepted values and range rules ---------------------------------------

CATEGORIES = ["gdp", "prices", "trade", "rates", "labor", "investment", "structure", "technology"]
FREQUENCIES = ["annual", "quarterly", "monthly", "daily", "sparse"]
GDP_LEVEL_CODES = ["NY.GDP.MKTP.CD", "NY.GDP.PCAP.CD", "NY.GNP.PCAP.CD"]

# --- Retrieval -------------------------------------------------------------

SYNONYMS = [
    ("lạm phát", ["inflation", "CPI", "consumer price index"]),
    ("tăng trưởng", ["GDP", "gross domestic product", "growth"]),
    ("thu nhập", ["GNI", "gross national income", "income"]),
    ("xuất khẩu", ["export", "exports", "trade"]),
    ("nhập khẩu", ["import", "imports", "trade"]),
    ("thất nghiệp", ["unemployment", "labor", "jobless"]),
    ("dân số", ["population", "demographics"]),
    ("đầu tư", ["FDI", "foreign direct investment", "investment"]),
    ("việt nam", ["Vietnam", "Viet Nam", "VN", "VNM"]),
]

COUNTRY_ALIASES = [
    ("việt nam", "VNM"), ("vietnam", "VNM"), ("vnm", "VNM"),
    ("indonesia", "IDN"), ("idn", "IDN"),
    ("thái lan", "THA"), ("thailand", "THA"), ("tha", "THA"),
    ("singapore", "SGP"), ("sgp", "SGP"),
    ("philippines", "PHL"), ("phl", "PHL"),
    ("malaysia", "MYS"), ("mys", "MYS"),
    ("brunei", "BRN"), ("brn", "BRN"),
    ("cambodia", "KHM"), ("campuchia", "KHM"), ("khm", "KHM"),
    ("laos", "LAO"), ("lao", "LAO"),
    ("myanmar", "MMR"), ("mmr", "MMR"),
    ("timor-leste", "TLS"), ("tls", "TLS"),
]
REGION_WORDS = ["asean", "đông nam á"]
REGION_COUNTRIES = ["VNM", "IDN", "THA", "SGP", "PHL", "MYS", "BRN", "KHM", "LAO", "MMR", "TLS"]
DEFAULT_COUNTRY = "VNM"
COMPARISON_WORDS = ["so sánh", "xu hướng", "tăng trưởng", "biến động", "trend", "compare"]
YEAR_PATTERN = r"\b(20\d{2})\b"

SEARCH_FIELDS = [
    # column, boost, kind
    ("indicator_name", 3.0, "text"),
    ("indicator_code", 2.0, "keyword"),
    ("description", 1.0, "text"),
    ("category", 1.0, "keyword"),
]
BM25_K1 = 1.2
BM25_B = 0.75
LEXICAL_SIZE = 10
LEXICAL_SIZE_IN_RETRIEVAL = 15
SEMANTIC_SIZE = 20
SEMANTIC_SIZE_IN_RETRIEVAL = 15
RRF_K = 60
FUSED_SIZE = 20

INDICATOR_ROW_CAP = 40
COUNTRY_ROW_CAP = 30
EXPANSION_CAP = 100
EXPANSION_CAP_IN_RETRIEVAL = 50

TYPE_WEIGHTS = [
    ("Indicator", 3.0),
    ("Document", 2.5),
    ("Country", 2.0),
    ("DataColumn", 0.8),
    ("DataTable", 0.5),
]
DEFAULT_WEIGHT = 1.0
LAYER_WEIGHTS = [("gold", 3.0), ("silver", 2.0), ("bronze", 1.0)]

CONTEXT_CHARS = 24000
DOCUMENT_CONTENT_CHARS = 1000
FACTS_HEADING = "--- REAL DATA VALUES ---"
NO_CONTEXT_MESSAGE = "Không tìm thấy thông tin ngữ cảnh nào phù hợp với câu hỏi của bạn."
CITATION_PATTERN = r"\[Doc_(\d+)\]"
CITATION_OPENING = "[Doc_"
DELIVERY_CHARS = 80
THOUSANDS_FORMAT = "#,##0.0################"

# --- Text ------------------------------------------------------------------

CHUNK_SIZE = 1500
CHUNK_OVERLAP = 200
PARAGRAPH_JOIN = "\n\n"

# The characters that count as white space in text cleaning, as a list (for
# trimming) and as a regular-expression class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
PARAGRAPH_BREAK = rf"\n{WHITESPACE_CLASS}*\n+|\r\n{WHITESPACE_CLASS}*\r\n+"
SENTENCE_BREAK = rf"(?<=[.!?]){WHITESPACE_CLASS}+|\n"
WORD_PATTERN = r"[\p{L}\p{M}\p{N}]{1,255}"

ABSTRACT_MIN_CHARS = 10
SEARCH_RESULT_CAP = 500
SEARCH_PAGE_SIZE = 50

UUID_DIGITS = r"^[0-9a-f]{32}$"
MESSAGE_ROLES = ["user", "assistant", "system"]
RATE_LIMIT_PER_MINUTE = 5
EMBED_BATCH = 20

# Plausible range of single indicators, by code; None is open.
INDICATOR_RANGES = [
    ("FP.CPI.TOTL.ZG", -50.0, 1000.0),
    ("SP.POP.TOTL", 0.0, None),
    ("NY.GDP.PCAP.CD", 100.0, 200000.0),
]
