"""Column names used across the library, and the fixed values of the method.

Operators take column names as parameters; these are the defaults.
"""

HOUSEHOLD = "household_id"
CUSTOMER = "customer_id"
TRANSACTION = "transaction_uid"
PRODUCT = "upc_id"
DATE = "date_id"
WEEK = "week_id"
PERIOD = "period_id"
SPEND = "net_spend_amt"
UNITS = "pkg_weight_unit"
CHANNEL = "channel"
SEGMENT = "seg_desc"
GROUP = "gr_nm"
RANK = "gr_sales_rank"
SALES = "sales"
AUDIENCE = "ca_nm"
QUOTA = "n_ca"
ARM = "arm"
HASHED_ID = "hashed_id"
GROUP_LIST = "gr_nm_list"
GROUP_COUNT = "n_gr"
RANK_MAP = "gr_rank_map"

#: Columns of a household's buying rhythm.
RHYTHM = (HOUSEHOLD, "last_date", "n_gaps", "cycle_days", "days_per_unit")

# Fixed values of the method (kept as the reference states them).
SEGMENT_LOOKBACK_DAYS = 180        # segment look-back from the campaign end
SMOOTHING_ALPHA = 0.5              # weight of the latest purchase cycle
CAMPAIGN_DAYS = 14                 # campaign window length in days
CONTROL_FRACTION = 0.05            # control share in every stratum
ONE_TIME_LABEL = "onetime"         # one distinct visit
MULTI_TIME_LABEL = "multitimes"    # two or more distinct visits

# Our own labels.
CHANNEL_DELIVERY = "delivery"
CHANNEL_PICKUP = "pickup"
SEGMENT_FILL_LABEL = "No segment data"
ARM_TEST = "test"
ARM_CONTROL = "ctrl"
