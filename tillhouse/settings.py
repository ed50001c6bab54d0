"""Values that decide results, in one place. Every function that uses one takes it as a parameter.

``BROADCAST_ROWS``, ``COPY_CHUNK`` and ``HOT_ROWS`` decide no result and are read where they are used.
"""

# They must equal the published warehouse's for the same results.
COUNTRY_COLUMNS = {"china_cnt": "China", "usa_cnt": "United States", "canada_cnt": "Canada"}
HOME_COUNTRY = "China"
GENDER_COLUMNS = {"male_customer_count": "Male", "female_customer_count": "Female"}
STORE_COLUMNS = {
    "lablaws_sale_factor": "Lablaws",
    "walmart_sale_factor": "Walmart",
    "foodmart_sale_factor": "FoodMart",
}
REPORT_YEAR = 2018
SCORES = (1, 2, 3, 4, 5)
GOOD_SCORE = 4
GOOD_REVIEWS_OVER = 3
GOOD_RATE = "0.67"
WEEK_TOP = 3
RECENT_DAYS = {"3_month": 90, "3_week": 21}
SALE_WEIGHTS = {
    "sum_amount": 0.1,
    "total_uq_customer_cnt": 0.1,
    "week_top3_count": 0.3,
    "week_avg_uq_counter_cnt": 0.1,
    "avg_month_add_customer_cnt": 0.3,
    "avg_review_score": 0.1,
}
FAITH_WEIGHTS = {
    "sum_amount": 0.07,
    "sum_count": 0.07,
    "month_avg_amount": 0.08,
    "month_avg_count": 0.08,
    "sum_amount_recent_3_month": 0.15,
    "sum_count_recent_3_month": 0.15,
    "sum_amount_recent_3_week": 0.2,
    "sum_count_recent_3_week": 0.2,
}

CALENDAR = ["tran_year", "tran_quarter", "tran_month", "tran_month_week", "tran_day", "tran_range"]

# Sizing, no effect on results.
BROADCAST_ROWS = 1_500_000  # a join side of more rows is not broadcast, however small its files are
CUBE_TASKS = 64  # tasks that write the customer-month table, and files of one month at most
COPY_CHUNK = 1_000_000  # exact copies of one row are written back in pieces of this many
HOT_ROWS = 10_000  # an id of more rows than this is spread over tasks when repeated ids are numbered
LOG_LINES = 500_000  # lines of a file of a compressed log, which one task reads
