"""Explicit schemas of the input tables (original column spellings kept)."""

ORDER_ITEMS = (
    "order_id string, order_item_id int, product_id string, price double, shipping_cost double"
)
PRODUCTS = (
    "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g int, "
    "product_length_cm int, product_height_cm int, product_width_cm int"
)
ORDER_PAYMENTS = (
    "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double"
)
ORDER_REVIEWS = (
    "review_id string, order_id string, review_score int, "
    "review_creation_date timestamp, review_answer_timestamp timestamp"
)
ORDERS = (
    "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp, order_approved_at timestamp, "
    "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
    "order_estimated_delivery_date timestamp"
)
# Amounts and dates of gifts come as text ("12,50", "31/12/2017") and are parsed later.
GIFTS = "donorID string, campaignID string, amount string, date string"
DONORS = (
    "donorID string, zipcode string, province string, region string, gender string, "
    "language string, dateOfBirth string"
)
SELECTION = "donorID string"
CAMPAIGNS = "campaignID string, date string, lettersSent int, CostUnit string"
NEWS = (
    "New_names string, ESG_results string, Date string, Label array<string>, Source string, "
    "Articles array<struct<description:string>>"
)
LABELLED_TEXTS = "text string, label int"
DAILY_TEMPERATURE = "Date string, Temperature string"
LEXICON = "token string, valence double"
LEMMAS = "token string, lemma string"
