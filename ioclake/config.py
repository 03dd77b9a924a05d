"""Fixed values and tunable defaults.

The values under "fixed values" must equal the original job's for the
same results; they are stated plainly and in their natural order.
Everything else is a parameter of the functions that use it.
"""

# ---------------------------------------------------------------------------
# fixed values (must match the original job's behaviour)
# ---------------------------------------------------------------------------

# index pages the original job starts from (seed list)
SEED_SITES = [
    "https://www.crowdstrike.com/blog/category/threat-intel-research/",
    "https://www.wiz.io/blog/tag/research",
    "https://www.mandiant.com/resources/blog",
    "https://www.microsoft.com/en-us/security/blog/topic/threat-intelligence/",
]
# substrings that mark an absolute link as an article link
ARTICLE_LINK_MARKERS = ["/blog/", "/research/"]
# links kept per index page, in document order, duplicates counted
LINKS_PER_SITE = 5
# tokens per analysis chunk (live default) and attempts per chunk
CHUNK_TOKENS = 7000
MAX_ATTEMPTS = 3
# analysis request settings
MODEL_NAME = "gpt-4"
TEMPERATURE = 0
REPLY_MAX_TOKENS = 1000
SYSTEM_PROMPT = (
    "You are a cybersecurity analyst specializing in threat intelligence. "
    "Your task is to analyze the given text and provide a structured JSON response."
)
USER_PROMPT_PREFIX = (
    "Analyze the following text and provide a JSON response with these keys: "
    "'Executive_Summary', 'Threat_Actors', 'TTPs', 'IOCs', 'Global_Impact', 'Recommendations'. "
    "Ensure all values are strings, and use empty strings for any sections without relevant information. "
    "Format lists as comma-separated strings within quotes. "
    "Your response should be a valid JSON object.\n\n"
    "Text to analyze:\n"
)
# keys of one analysis reply, in order; which of them are list-valued
REPLY_KEYS = ["Executive_Summary", "Threat_Actors", "TTPs", "IOCs",
              "Global_Impact", "Recommendations"]
REPLY_LIST_KEYS = ["Threat_Actors", "TTPs", "IOCs", "Recommendations"]
REPLY_LIST_SEPARATOR = ", "
# entity labels feeding each output
ACTOR_LABELS = ["ORG", "PERSON", "NORP"]
TARGET_LABELS = ["GPE", "ORG", "PRODUCT"]
TACTIC_LABELS = ["EVENT", "WORK_OF_ART"]
TECHNIQUE_LABELS = ["WORK_OF_ART", "LAW"]
TTP_LABELS = ["EVENT", "WORK_OF_ART", "LAW"]
IOC_LABELS = ["PRODUCT", "GPE", "LOC", "FAC", "MONEY", "CARDINAL"]
# phrases that make an actor's sentence its motivation
MOTIVATION_PHRASES = ["motivated by", "aims to", "goal is", "objective is",
                      "intends to", "purpose is"]
# report constants
REPORT_VERSION = "0.1.0"
REPORT_GENERATOR = "ioclake"  # report `generated_by`; a parameter of build_report

# ---------------------------------------------------------------------------
# our own decisions (not from the original job)
# ---------------------------------------------------------------------------

# Markers used when the link operators run on the driver's synthetic
# `pages` table, whose links never contain /blog/ or /research/.
TESTDATA_LINK_MARKERS = ["/th", "/de"]

# Merge ranks that chunks are counted by (the original's own vocabulary is not
# at hand; any file of base64 tokens and ranks will do) and tokens a chunk in
# the query, so that texts fall into several.
BPE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TESTDATA_BPE_CHUNK = 200

# Gazetteer used when mentions are found by lookup on the synthetic prose.
# Terms of any length are matched case-insensitively inside a sentence.
TESTDATA_GAZETTEER = [
    ("that", "ORG"),
    ("with", "PERSON"),
    ("und", "NORP"),
    ("from", "GPE"),
    ("this", "PRODUCT"),
    ("by", "EVENT"),
    ("of the", "WORK_OF_ART"),
    ("in the", "LAW"),
    ("der", "LOC"),
    ("les", "FAC"),
    ("for", "MONEY"),
    ("que", "CARDINAL"),
    ("on the", "ORG"),
    ("to the", "GPE"),
    ("and the", "PRODUCT"),
    ("it is", "EVENT"),
    ("de la", "NORP"),
    ("one of the", "PERSON"),
]

# Generic top-level domains a bare host.tld token may end with to look like
# a URL; any two-letter alphabetic ending (country code) also counts.
URL_GENERIC_TLDS = ["com", "org", "net", "edu", "gov", "mil", "int", "info",
                    "biz", "name", "pro", "io", "app", "dev", "xyz", "online",
                    "site", "top", "club", "shop", "onion"]
