"""Fixed schemas of the input files."""

# Table name -> column list, in file order.
TABLES = {
    "customer_transaction_data": (
        "date date, customer_id bigint, item_id bigint, quantity double, selling_price double, "
        "other_discount double, coupon_discount double"
    ),
    "item_data": "item_id bigint, brand bigint, brand_type string, category string",
    "campaign_data": "campaign_id int, campaign_type string, start_date string, end_date string",
    "coupon_item_mapping": "coupon_id bigint, item_id bigint",
    "train": "id bigint, campaign_id int, coupon_id bigint, customer_id bigint, redemption_status int",
    "test": "id bigint, campaign_id int, coupon_id bigint, customer_id bigint",
    "submission": "id bigint, redemption_status double",
    "importance": "feature string, split bigint, gain double",
}
