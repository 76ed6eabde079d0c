"""Fixed values of the captured service's wire protocol and client defaults.

Service host names and the resource-key header name are *parameters* of the
operators that need them (callers pass the values their captures use); the
defaults below are neutral placeholders, except where marked.
"""

# --- fixed values (must equal the replayed client's for identical results) ---
QUERY_PATH = "public/reports/querydata"   # request path marker of a query POST
DEFAULT_MODEL_ID = 598501                  # model id when a capture carries none
PAGE_SIZE = 30000                          # rows requested per page (Window.Count)
MAX_RETRIES = 4                            # attempts after the first one
RETRY_BASE_DELAY = 1.0                     # seconds, doubled per attempt
RETRYABLE_STATUS = (429, 500, 502, 503, 504)
AUTH_STATUS = (401, 403)
PAYLOAD_VERSION = "1.0.0"
DATA_VOLUME = 3                            # DataReduction default when a template has none
# --- end of fixed values ---

# Parameters with neutral defaults.
VIEW_URL_PREFIX = "https://app.example.com/view?r="
RESOURCE_KEY_HEADER = "X-ResourceKey"
