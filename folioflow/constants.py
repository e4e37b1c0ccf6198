"""These must stay exactly as they are for results to agree."""

# Body dimension, id -> name, and the name used when an id is unknown.
BODIES = [
    ("1", "Employment Appeals Tribunal"),
    ("2", "Equality Tribunal"),
    ("3", "Labour Court"),
    ("15376", "Workplace Relations Commission"),
]
DEFAULT_BODY_NAME = "Workplace Relations"

# Content types by lower-case extension.
CONTENT_TYPES = {
    "pdf": "application/pdf",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "html": "text/html",
    "htm": "text/html",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"

# Document types that are cleaned; everything else is copied as is.
HTML_TYPES = ["html", "htm"]

# Attachment extensions in the order they are tried.
ATTACHMENT_TYPES = ["pdf", "doc", "docx"]

MONTHS = [
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
]

# Dates inside running text, tried in this order.
TEXT_DATE_PATTERNS = [
    r"(\d{2}/\d{2}/\d{4})",
    r"(\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{4})",
]
TEXT_DATE_WINDOW = 20000
URL_DATE_PATTERN = r"/cases/(\d{4})/([^/]+)/"

# Default years for the coarse candidate filter.
FIRST_YEAR = "1986"
LAST_YEAR = "2030"

# Markup that never carries content.
STRIPPED_TAGS = ["script", "style", "noscript", "meta", "link"]
NAVIGATION_SELECTORS = [
    "nav",
    ".navbar",
    ".navigation",
    ".menu",
    ".sidebar",
    ".header",
    "header",
    ".footer",
    "footer",
    ".breadcrumb",
    ".pagination",
    ".share-buttons",
    ".social-share",
    ".related-links",
    ".comments",
    "aside",
    ".advertisement",
    ".ads",
    ".popup",
    "#nav",
    "#sidebar",
    "#footer",
    "#header",
]

# Where the main content is looked for, in order.
CONTENT_SELECTORS = [
    "main",
    "article",
    ".content",
    ".main-content",
    ".decision-content",
    ".document-content",
    "#content",
    ".post-content",
    ".entry-content",
    ".page-content",
]
MIN_SELECTED_TEXT = 200
MIN_DIV_TEXT = 300
MIN_WRAPPER_TEXT = 10
UNWRAPPED_TAGS = ["span", "div"]

# HTML elements that have no content and are written as <name/>.
VOID_TAGS = [
    "area",
    "base",
    "basefont",
    "bgsound",
    "br",
    "col",
    "command",
    "embed",
    "frame",
    "hr",
    "image",
    "img",
    "input",
    "isindex",
    "keygen",
    "link",
    "menuitem",
    "meta",
    "nextid",
    "param",
    "source",
    "spacer",
    "track",
    "wbr",
]

# Interstitial pages: status codes and text markers.
CHALLENGE_STATUSES = [403, 503]
CHALLENGE_MARKERS = [
    "cf-browser-verification",
    "cf_chl_opt",
    "Checking your browser",
    "cf-challenge-running",
    "_cf_chl_tk",
    "just a moment",
    "Attention Required",
    "cloudflare",
]
CHALLENGE_WINDOW = 5000
RATE_LIMIT_STATUS = 429
DEFAULT_RETRY_AFTER = 30
EDGE_ERROR_STATUSES = (520, 524)
# First and last status of a successful answer.
SUCCESS_STATUSES = (200, 299)
