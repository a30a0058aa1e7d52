"""Declared schemas of the raw tables. Never inferred; columns bind by name.

Ids, codes and times are text in the raw zone, money is decimal(16,2), counts are
bigint. The layouts below are fixed values: column order is the file's order.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY_COLUMNS = {
    "total_amount",
    "order_price",
    "price",
    "weight",
    "refund_amount",
    "discount_amount",
    "threshold_amount",
    "feight_fee",
    "benefit_reduce_amount",
    "original_total_amount",
}
COUNT_COLUMNS = {"sku_num", "refund_num"}

RAW_COLUMNS = {
    "user_info": "id login_name nick_name name phone_num email head_img user_level birthday gender "
    "create_time operate_time status",
    "sku_info": "id spu_id price sku_name sku_desc weight tm_id category3_id create_time",
    "spu_info": "id spu_name description tm_id category3_id create_time",
    "base_trademark": "tm_id tm_name logo_url create_time",
    "base_category1": "id name create_time",
    "base_category2": "id name category1_id create_time",
    "base_category3": "id name category2_id create_time",
    "base_province": "id name region_id area_code iso_code",
    "base_region": "id region_name",
    "order_info": "id consignee consignee_tel total_amount order_status user_id payment_way "
    "delivery_address order_comment out_trade_no trade_body create_time operate_time expire_time "
    "tracking_no parent_order_id img_url province_id benefit_reduce_amount original_total_amount "
    "feight_fee sku_num",
    "order_detail": "id order_id sku_id sku_name img_url order_price sku_num create_time source_type "
    "source_id",
    "order_status_log": "id order_id order_status operate_time operate_user_id remark",
    "payment_info": "id out_trade_no order_id user_id payment_type trade_no total_amount subject "
    "payment_status create_time callback_time",
    "order_refund_info": "id order_id sku_id refund_type refund_num refund_amount refund_reason_type "
    "refund_reason_txt refund_status create_time operate_time",
    "coupon_info": "id coupon_name coupon_type coupon_desc discount_amount threshold_amount start_time "
    "end_time create_time",
    "coupon_use": "id coupon_id user_id order_id coupon_status create_time used_time expire_time",
    "activity_info": "id activity_name activity_type activity_desc start_time end_time create_time",
    "activity_order": "id activity_id order_id create_time",
    "comment_info": "id user_id sku_id order_id appraisal_star ip_opt create_time appraise",
    "favor_info": "id user_id sku_id create_time cancel_time",
    "cart_info": "id user_id sku_id sku_num create_time operate_time",
    "customer_service": "id user_id order_id sku_id service_type service_content create_time "
    "handle_time handle_result",
    "action_page_view": "user_id sku_id session_id action_time page_id",
    "action_favor_add": "user_id sku_id session_id create_time favor_id",
    "action_cart_add": "user_id sku_id session_id create_time cart_id",
    "action_order": "user_id sku_id session_id create_time order_detail_id order_id",
}


def raw_schema(table: str) -> T.StructType:
    """Schema of a raw table."""

    def kind(column: str) -> T.DataType:
        if column in MONEY_COLUMNS:
            return T.DecimalType(16, 2)
        return T.LongType() if column in COUNT_COLUMNS else T.StringType()

    return T.StructType([T.StructField(c, kind(c)) for c in RAW_COLUMNS[table].split()])
