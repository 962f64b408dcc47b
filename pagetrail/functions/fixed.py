"""Names and limits that decide the results."""

# Event names with a meaning of their own.
PAGE_VIEW = "page_view"
USER_ENGAGEMENT = "user_engagement"
SCROLL = "scroll"
VIEW_ITEM = "view_item"
ADD_TO_CART = "add_to_cart"
BEGIN_CHECKOUT = "begin_checkout"
PURCHASE = "purchase"

# Parameter keys.
SESSION_ID = "ga_session_id"
SESSION_NUMBER = "ga_session_number"
PAGE_LOCATION = "page_location"
PAGE_TITLE = "page_title"
PAGE_REFERRER = "page_referrer"
SOURCE = "source"
MEDIUM = "medium"
CAMPAIGN = "campaign"
PERCENT_SCROLLED = "percent_scrolled"

# Funnel: (step name, event name, step order).
FUNNEL_STEPS = (
    ("view_product", VIEW_ITEM, 1),
    ("add_to_cart", ADD_TO_CART, 2),
    ("begin_checkout", BEGIN_CHECKOUT, 3),
    ("purchase", PURCHASE, 4),
)

# A session ends when the whole minutes to the next event exceed this.
GAP_MINUTES = 30

# Calendar range.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"

# URL patterns.
HOST_PATTERN = r"https?://([^/]+)"
PATH_PATTERN = r"https?://[^/]+([^\n]*)"
QUERY_OR_FRAGMENT_PATTERN = r"(\?|#)[^\n]*\z"

# Page types of a shop, first match wins; matched against the lower-case URL.
PAGE_TYPE_RULES = (
    ("Cart", r"/(cart|basket)"),
    ("Checkout", r"/(checkout|payment|yourinfo|ordercompleted|revieworder)"),
    ("Wishlist", r"/wishlist"),
    ("Account", r"/(account|myaccount|signin|login|register)"),
    ("Search", r"/(search|asearch)"),
    ("Support / Policies", r"/(support|help|faq|contact|policy|policies|privacy|terms|shipping|returns)"),
    ("Home", r"^https?://[^/]+(/(home|index(\.html?)?))?/?$"),
    ("Browse / Product", r"^https?://[^/]+/."),
)
OTHER_PAGE_TYPE = "Other"

# Display labels of traffic sources; any other source is shown as it is.
UNATTRIBUTED = "Unattributed"
SOURCE_LABELS = (
    ("(direct)", "Direct"),
    ("<Other>", "Other"),
    ("(data deleted)", "Data deleted"),
)
