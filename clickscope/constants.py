"""Values the jobs share with the original application."""

# These must equal the original's for the same results.
TOP_CATEGORIES = 10  # categories kept by the category ranking
TOP_SESSIONS = 10  # sessions kept per hot category
TOP_PRODUCTS = 3  # products kept per area
NO_CLICK = -1  # click_category_id / click_product_id of an action that is not a click
ID_LIST_SEPARATOR = ","  # order / pay id lists, and the target page flow
PAGE_FLOW_SEPARATOR = "-"  # "from-to" text of a page jump
CLICK = "click"
ORDER = "order"
PAY = "pay"
DATE_FORMAT = "yyyy-MM-dd"  # the action table's date column
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"  # the action table's action_time column
PARAMS_KEY = "condition.params.json"  # properties key holding the job parameters
