"""Fixed values of the disclosure domain: codes, word lists, ranges, names.

Everything in this module is data that has to be exactly as it is for results
to be right.  It holds no logic.
"""

# --- fixed values: value codes of the judiciary form and their ranges
VALUE_RANGES = {
    "J": "$1,001 - $15,000",
    "K": "$15,001 - $50,000",
    "L": "$50,001 - $100,000",
    "M": "$100,001 - $250,000",
    "N": "$250,001 - $500,000",
    "O": "$500,001 - $1,000,000",
    "P1": "$1,000,001 - $5,000,000",
    "P2": "$5,000,001 - $25,000,000",
    "P3": "$25,000,001 - $50,000,000",
    "P4": "Over $50,000,000",
}

# --- fixed values: other single-token codes of the judiciary form
INCOME_CODES = "A B C D E F G H1 H2".split()
VALUE_CODES = "J K L M N O P1 P2 P3 P4".split()
METHOD_CODES = "Q R S T U V W".split()
JUDICIAL_TX_WORDS = "buy sold sell redeemed exchange purchase".split()
JUDICIAL_INCOME_WORDS = "dividend interest rent capital none royalties other".split()

# --- fixed values: phrases that mark form furniture on judiciary pages
JUDICIAL_NOISE = [
    "FINANCIAL DISCLOSURE REPORT",
    "Name of Person Reporting",
    "Date of Report",
    "Description of Assets",
    "Income during",
    "Gross value",
    "Transactions during",
    'Place "(X)"',
    "exempt from prior",
    "(A-H)",
    "(J-P)",
    "(Q-W)",
    "NONE (No reportable",
    "A. B. C. D.",
    "-- income, value",
    "reporting period",
    "of reporting period",
    "Code 1 div.,",
    "buy, sell,",
    "Code 3 redemption",
    "mm/dd/yy",
]

# --- fixed values: phrases that mark form furniture on executive pages
EXECUTIVE_NOISE = [
    "Instructions for Part",
    "Instructions for Schedule",
    "Note: This is a public form",
    "If you need more pages",
    "Note: You must add pages",
    "Filer's Name",
    "Page Number",
    "<!-- page",
    "# Description",
    "Underlying Assets and Location",
    "EIF Value Income",
    "Description EIF Value",
]
EXECUTIVE_NOT_A_NAME = [
    "location:",
    "ownership",
    "inactive",
    "see line",
    "underlying asset",
    "intentionally left blank",
    "additional underlying",
]

# --- fixed values: party of the nine justices by last name
JUSTICE_PARTY = {
    "roberts": "Republican",
    "thomas": "Republican",
    "alito": "Republican",
    "gorsuch": "Republican",
    "kavanaugh": "Republican",
    "barrett": "Republican",
    "sotomayor": "Democrat",
    "kagan": "Democrat",
    "jackson": "Democrat",
}

# --- fixed values: directed first-name expansions (typed name, other form)
NICKNAMES = {
    "mike": "michael", "michael": "mike",
    "ted": "theodore", "theodore": "ted",
    "chuck": "charles", "charles": "chuck",
    "bill": "william", "william": "bill",
    "bob": "robert", "rob": "robert",
    "jim": "james", "james": "jim",
    "dick": "richard", "rick": "richard", "rich": "richard",
    "tom": "thomas", "thomas": "tom",
    "joe": "joseph", "joseph": "joe",
    "jack": "john",
    "tim": "timothy", "timothy": "tim",
    "dan": "daniel", "daniel": "dan",
    "ben": "benjamin", "benjamin": "ben",
    "dave": "david", "david": "dave",
    "pete": "peter", "peter": "pete",
    "tony": "anthony", "anthony": "tony",
    "frank": "francis", "francis": "frank",
    "andy": "andrew", "andrew": "andy",
    "pat": "patrick", "patrick": "pat",
    "liz": "elizabeth", "beth": "elizabeth",
    "lizzie": "elizabeth", "elizabeth": "lizzie",
    "sue": "susan", "susan": "sue",
    "al": "albert",
    "fred": "frederick", "frederick": "fred",
    "ed": "edward", "edward": "ed",
    "ron": "ronald", "ronald": "ron",
    "don": "donald", "donald": "don",
    "sam": "samuel", "samuel": "sam",
    "ken": "kenneth", "kenneth": "ken",
    "gary": "garland",
    "greg": "gregory", "gregory": "greg",
    "mitch": "addison",
    "zach": "zachary", "zachary": "zach",
    "jake": "jacob", "jacob": "jake",
}

# The expansions used when member aliases are rendered leave these out.
NICKNAMES_NOT_FOR_ALIASES = {"lizzie", "elizabeth", "zach", "zachary", "jake", "jacob"}

# --- fixed values: credentials that leak into name fields
CREDENTIALS = (
    "md do phd dds dmd jd mba esq facs facc rn ms dnp np dvm lcsw lpc mph"
).split()

# --- fixed values: last names used on filings -> last name on the roster
MANUAL_LAST_NAMES = {
    "arenholz": "hinson",
    "paulina luna": "luna",
    "amata": "radewagen",
    "justice ii": "justice",
    "coleman": "watson coleman",
}

# --- fixed values: (last name on filings, roster last, roster first)
MANUAL_MEMBER_ALIASES = [
    ("Arenholz", "Hinson", "Ashley"),
    ("Paulina Luna", "Luna", "Anna"),
    ("Amata", "Radewagen", "Aumua Amata"),
]

# --- fixed values: filers that no legislator roster lists
# (key, last, alias first names, display, party, is_current)
PRINCIPALS = [
    ("EXEC_TRUMP", "Trump", ["Donald", "Donald J.", "Donald John", "Donald J"],
     "Donald", "Republican", 1),
    ("D000671_SYN", "Delaney", ["April McClain", "April"], "April", "Democrat", 1),
]
# (key, last, resolver first names, first year, last year)
PRINCIPAL_INDEX = [
    ("EXEC_TRUMP", "trump", ["donald", "donald j", "donald john", "donald j."], 2017, 2099),
    ("D000671_SYN", "delaney", ["april mcclain", "april"], 2025, 2099),
]

# --- fixed values: the nine justices (last, first)
JUSTICES = [
    ("Roberts", "John"),
    ("Thomas", "Clarence"),
    ("Alito", "Samuel"),
    ("Sotomayor", "Sonia"),
    ("Kagan", "Elena"),
    ("Gorsuch", "Neil"),
    ("Kavanaugh", "Brett"),
    ("Barrett", "Amy"),
    ("Jackson", "Ketanji"),
]

# --- fixed values: members whose annual filing is a scan (doc id, last, first, state, office)
SCANNED_FILERS = [
    ("8221132", "Bilirakis", "Gus M.", "FL", "FL12"),
    ("8221133", "Carey", "Mike", "OH", "OH15"),
    ("9115587", "Chavez-DeRemer", "Lori", "OR", "OR05"),
    ("9115612", "Ciscomani", "Juan", "AZ", "AZ06"),
    ("8221125", "Courtney", "Joe", "CT", "CT02"),
    ("8221134", "D'Esposito", "Anthony", "NY", "NY04"),
    ("8221130", "Fleischmann", "Charles J.", "TN", "TN03"),
    ("9115581", "Guest", "Michael", "MS", "MS03"),
    ("8221136", "Guthrie", "Brett", "KY", "KY02"),
    ("9115594", "Harshbarger", "Diana", "TN", "TN01"),
    ("9115596", "Kilmer", "Derek", "WA", "WA06"),
    ("8221137", "Matsui", "Doris O.", "CA", "CA07"),
    ("9115586", "McCaul", "Michael T.", "TX", "TX10"),
    ("8221127", "Neguse", "Joe", "CO", "CO02"),
    ("8221138", "O'Halleran", "Tom", "AZ", "AZ01"),
    ("9115593", "Rogers", "Harold", "KY", "KY05"),
    ("8221131", "Rogers", "Mike", "AL", "AL03"),
    ("8221149", "Self", "Keith", "TX", "TX03"),
    ("8221129", "Sherrill", "Mikie", "NJ", "NJ11"),
    ("9115582", "Steil", "Bryan", "WI", "WI01"),
    ("8221141", "Tokuda", "Jill", "HI", "HI02"),
]

# --- fixed values: roster rows known to carry the wrong document id (last, first, office, wrong id)
WRONG_DOC_IDS = [
    ("Blumenauer", "Earl", "OR03", "10070343"),
    ("Gimenez", "Carlos", "FL28", "10066804"),
    ("McHenry", "Patrick", "NC10", "10068784"),
    ("Phillips", "Dean", "MN03", "10067550"),
]

# --- fixed values: last names checked when filings stay unmatched
SUSPECT_LAST_NAMES = [
    "Amata", "Arenholz", "Barragan", "Chavez-DeRemer", "Connolly", "D'Esposito",
    "D'esposito", "Greene", "Garcia", "LaMalfa", "Gonzales", "Kilmer", "Luna",
    "Murphy", "Sanchez", "Sherrill", "O'Halleran", "O'halleran", "Scott", "Swalwell",
]

# --- fixed values: companies meant by the sector words of the example questions
SECTORS = {
    "social": ["Meta", "Facebook", "Twitter", "Snap", "Pinterest", "TikTok",
               "LinkedIn", "Reddit", "YouTube"],
    "tech": ["Apple", "Microsoft", "Google", "Alphabet", "Amazon", "NVIDIA", "Meta"],
    "energy": ["Exxon", "Chevron", "Shell", "BP", "ConocoPhillips", "Halliburton"],
    "defense": ["Raytheon", "Lockheed", "Boeing"],
}

# --- fixed values: columns a result may be sorted by
HOLDING_SORT_COLUMNS = [
    "chamber", "last_name", "first_name", "state", "asset", "asset_type", "owner",
    "value", "income_type",
]
TRANSACTION_SORT_COLUMNS = [
    "chamber", "last_name", "first_name", "state", "transaction_date",
    "disclosure_date", "asset", "asset_type", "transaction_type", "amount", "ticker",
]

# --- fixed values: patterns of the cells and lines of the forms
MONEY = r"\$[\d,]+"
DATE_CELL = r"^\d{1,2}/\d{1,2}/\d{2,4}$"
ANY_DATE = r"\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}"
TX_TYPE_CELL = r"(?i)^(?:P|S|S\s*\(partial\)|Buy|Sell|Exchange)$"
TX_TYPE_WORDS = r"(?i)\b(purchase|sale\s*\(full\)|sale\s*\(partial\)|exchange|received)"
OWNER_HEAD = r"(?i)^(DC|SP|JT|dep\.?\s*child)\s+"

# --- fixed values: patterns of the judiciary form
JUDICIAL_LEGEND = r"(?i)^\d+\.\s+(Income Gain Codes|Value Codes|Value Method)"
JUDICIAL_PAGE = r"(?i)^(Page\s+\d+\s+of\s+\d+|<!--\s*page\s+\d+)"
JUDICIAL_CONTINUED = r"(?i)^\((?:part\.?|add'?l\.?)\)\s*"

# --- fixed values: patterns of the executive form
EXECUTIVE_SCHEDULE = r"(?i)^Schedule\s+1\s+for\s+Part\s+(\d+)"
EXECUTIVE_PART = r"(?i)^Part\s+(\d+)[:\s]"
EXECUTIVE_ROW = r"^\d+(?:\.\d+)?\s+"
EXECUTIVE_MONEY = (
    r"(?i)(None\s*\(or less than[^)]+\)"
    r"|\$[\d,]+(?:\s*(?:to|-)\s*\$?[\d,]+(?:\.\d+)?)?)"
)
EXECUTIVE_INCOME = r"(?i)\b(DIVIDEND|INTEREST|RENT|ROYALT\w+|OTHER)\b"
EIF_START = r"(?i)^(?:Yes|No|N/A)\b"
EIF_INSIDE = r"(?i)^(.*?)(\s+(?:Yes|No|N/A)\s+.*)$"

# --- fixed values: patterns of periodic reports whose cells are merged
SPLIT_AMOUNT = r"\$[\d,]+\s*-\s*$"
ONE_AMOUNT = r"\$[\d,]+(?:\.\d+)?"
MONEY_RANGE = r"(\$[\d,]+\s*[-–]\s*\$[\d,]+)"
MERGED_TYPE = (
    r"(?:^|\s)((?i:S\s*\(partial\)|S\s*\(full\)|Sale\s*\(partial\)|Sale\s*\(full\)"
    r"|Exchange\s+\(New\)|Received\s*\(New\))|P|S)(?:\s|$)"
)
