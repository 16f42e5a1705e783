"""Constants, texts and patterns that results depend on."""

# --- Fixed values: cleaning rules -------------------------------------------------
PRICE_FLOOR = 0.0
PRICE_CEILING = 100000.0
FALLBACK_PRICE = 9.99
COST_SHARE = 0.5
DEFAULT_BRAND = "UNBRANDED"
DEFAULT_DEPARTMENT = "GENERAL"
ERR_MISSING_NAME = "ERR_MISSING_NAME"
ERR_INVALID_PRICE = "ERR_INVALID_PRICE"
ERR_PRICE_TOO_HIGH = "ERR_PRICE_TOO_HIGH"
ERR_NEGATIVE_COST = "ERR_NEGATIVE_COST"
ERR_COST_GT_PRICE = "ERR_COST_GT_PRICE"

# --- Fixed values: quality limits -------------------------------------------------
EMBEDDING_DIM = 1536
EMBEDDING_GAP = 0.05
CLUSTERING_GAP = 0.20
ENRICHMENT_GAP = 0.05
MIN_CLUSTERS = 10

# --- Fixed values: clustering -----------------------------------------------------
MIN_CLUSTER_SIZE = 15
MIN_SAMPLES = 10
REDUCED_DIM = 50
NOISE = -1
LABEL_SAMPLE_IDS = 20
LABEL_SAMPLE_USED = 15
LABEL_MAX_CHARS = 100

# --- Fixed values: vector index and retrieval -------------------------------------
IVF_LISTS = 100
INDEX_MIN_ROWS = 5000
NPROBE = 20
RECALL = 0.95
SEARCH_OVERFETCH = 5
INTENT_POOL = 120
BRIEF_PRODUCTS = 5

# --- Fixed values: batches, unit prices, tones ------------------------------------
EMBEDDING_BATCH = 250
EMBEDDING_USD_PER_TOKEN = 0.00000002
GENERATION_USD_PER_TOKEN_IN = 0.00000015
GENERATION_USD_PER_TOKEN_OUT = 0.00000060
DESCRIPTION_TONE = "luxury_retail"
ERROR_MAX_CHARS = 500

# --- Fixed values: dashboard limits -----------------------------------------------
SALES_WINDOW_DAYS = 180
BRANDS_PER_LABEL = 10
TOP_CLUSTERS = 40
TOP_PRICING = 20
BRANDS_CHART_ROWS = 100
CARD_LABELS = 6
CARD_BRANDS = 5
CLUSTER_PRODUCTS = 200
PAGE_SIZE = 30
BAND_GREEN = 80
BAND_ACCENT = 50

# --- Fixed values: prompt texts ({...} marks a column) ----------------------------
DESCRIPTION_PROMPT = (
    "You are a luxury retail copywriter. Write exactly 50 words describing this product "
    "in an aspirational, luxury_retail tone. No bullet points. No markdown. Just flowing prose.\n\n"
    "Product: {name}\nBrand: {brand}\nCategory: {category} / {department}\n{cluster}"
)
CLUSTER_SENTENCE = "Cluster: {cluster_label}."
LABEL_PROMPT = (
    "You are a luxury retail brand strategist. Given these product names, generate a 2-5 word "
    "cluster label that captures their common luxury retail theme. "
    "Reply with ONLY the label, no explanation.\n\nProducts:\n{samples}"
)
BRIEF_PROMPT = (
    "You are a retail merchandising expert.\n"
    'A buyer described this intent: "{intent}"\n\n'
    'One matching product cluster is: "{cluster_label}" '
    "(avg price €{avg_price}, sample products: {names}).\n\n"
    "In 3 short fields (1-2 sentences each), respond with JSON:\n"
    '{"positioning": "...", "price_range": "...", "buyer_action": "..."}\n'
    "positioning: what this cluster represents for the buyer.\n"
    "price_range: exact range as '€X–€Y'.\n"
    "buyer_action: one concrete recommendation for Q-next assortment."
)

# --- Fixed values: price phrases in search texts (lower case) ---------------------
# WS spells out every blank a browser counts as \s.
WS = r"[\s\x{0b}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*"
SIGN = r"[$€£]?"
NUMBER = r"(\d+(?:[,.]\d+)?)"
MAX_BEFORE = r"(?:moins de|under|max(?:imum)?|jusqu['`]?à|pas plus de|au dessus de)"
MAX_AFTER = r"(?:max(?:imum)?|ou moins|et moins)"
MIN_BEFORE = r"(?:plus de|over|min(?:imum)?|au moins|à partir de)"
MIN_AFTER = r"(?:min(?:imum)?|ou plus|et plus)"
RANGE_OPEN = r"(?:entre|between)"
RANGE_JOIN = r"(?:et|and|-)"
# Corrected phrases: "pas plus de" is no minimum, "au dessus de" is one.
STRICT_MAX_BEFORE = r"(?:moins de|under|max(?:imum)?|jusqu['`’]?à|pas plus de)"
STRICT_MIN_BEFORE = r"(?:(?<!pas )plus de|over|min(?:imum)?|au moins|à partir de|au dessus de)"
