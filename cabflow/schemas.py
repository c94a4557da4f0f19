"""Field order and types of every input format.

A format is a list of ``(name, spark_type)`` pairs.  Delimited and pattern
sources are positional, so the order below is part of the data contract.
"""

from __future__ import annotations

from dataclasses import dataclass

Fields = list[tuple[str, str]]


def fields(text: str) -> Fields:
    """Turn ``"a:int b:string"`` into ``[("a", "int"), ("b", "string")]``."""
    return [tuple(item.rsplit(":", 1)) for item in text.split()]


def names(schema: Fields) -> list[str]:
    return [name for name, _ in schema]


def without(schema: Fields, *dropped: str) -> Fields:
    return [field for field in schema if field[0] not in dropped]


# ---------------------------------------------------------------------------
# The field order of the files that are read.
# ---------------------------------------------------------------------------

SERVICE_ORDER = """
    service_order_id:bigint product_type_id:int fixed_product_id:int is_asap:tinyint source:int
    platform:tinyint status:tinyint rc_status:tinyint end_status:tinyint abnormal_mark:tinyint
    flag:bigint account_id:bigint user_id:bigint user_phone:string passenger_name:string
    passenger_phone:string corporate_id:bigint corporate_dept_id:int city:string reason_id:int
    flight_number:string create_time:int update_time:int init_time:int select_car_time:int
    arrival_time:int cancel_time:int car_id:int car_type_id:int car_type_ids:string
    car_type:string car_brand:string driver_id:int driver_phone:string driver_name:string
    vehicle_number:string expect_start_time:int expect_end_time:int start_time:int end_time:int
    confirm_time:int start_position:string start_address:string end_position:string
    end_address:string expect_start_latitude:double expect_start_longitude:double
    expect_end_latitude:double expect_end_longitude:double start_latitude:double
    start_longitude:double end_latitude:double end_longitude:double payment:string
    refund_status:tinyint pay_method:tinyint pay_status:tinyint
    first_recharge_transaction_id:bigint first_recharge_amount:decimal(10,2)
    coupon_member_id:bigint coupon_name:string coupon_type:tinyint coupon_facevalue:decimal(8,2)
    discount:decimal(8,2) version:int fee_version:int balance_status:tinyint payable:tinyint
    total_amount:decimal(8,2) deposit:decimal(8,2) loan_in_credit:decimal(10,2)
    pay_amount:decimal(10,2) min_amount:decimal(10,2) origin_amount:decimal(8,2)
    origin_sharing_amount:decimal(10,2) sharing_amount:decimal(10,2) actual_time_length:int
    dependable_distance:int mileage:int system_distance:int alitongxin_secret_no_x:string
    alitongxin_subs_id:bigint alitongxin_status:tinyint passenger_session_id:string
    last_operator:string time_length:int operation:string
"""

SERVICE_ORDER_EXT = """
    service_order_id:bigint operator_id:int user_type:tinyint sms:string
    create_order_longitude:double create_order_latitude:double confirm_latitude:double
    confirm_longitude:double arrive_latitude:double arrive_longitude:double src_city_name:string
    dst_city_name:string dest_city:string dispatch_driver_ids:string change_driver_reason_id:int
    before_cancel_status:tinyint app_version:string driver_version:string balance_time:int
    balance_result:tinyint preauth_status:tinyint extra_amount:decimal(8,2)
    predict_amount:decimal(10,2) night_amount:decimal(10,2) driver_amount:decimal(8,2)
    predict_origin_amount:decimal(10,2) predict_pay_amount:decimal(10,2)
    additional_time_amount:decimal(8,2) highway_amount:decimal(8,2) parking_amount:decimal(8,2)
    addons_amount:decimal(8,2) addons_amount_src:string other_amount:decimal(8,2) runtime:int
    total_distance:int deadhead_distance:int is_night:tinyint regulatepan_amount:decimal(8,2)
    regulatedri_amount:decimal(8,2) regulatepan_reason:string regulatedri_reason:string
    regulate_amount:decimal(8,2) estimate_snap:string app_msg:string comment:string ip:string
    order_port:int confirm_ip:string confirm_port:string create_time:int update_time:int
    operation:string
"""

DISPATCH_INFO = """
    datetime:string service_order_id:bigint dispatch_count:smallint response_count:smallint
    accept_count:smallint flag:int dispatch_time:int decision_time:int contribution:int
    expect_decision_time:int dispatch_template_id:int template_snapshot:string status:tinyint
    dispatch_type:tinyint decision_type:tinyint round:tinyint batch:tinyint create_time:int
    update_time:int estimate_time:int can_dispatch_count:smallint user_id:bigint
    user_level:tinyint user_name:string user_gender:string add_price_redispatch:smallint
    add_price_info:string decision_driver_id:bigint decision_car_type_id:tinyint
    bidding_id:bigint bidding_rate:double driver_bidding_rate:double estimate_price:int
    driver_estimate_price:int city:string
"""

DISPATCH_DETAIL = """
    datetime:string service_order_id:bigint round:tinyint batch:tinyint flag:int
    driver_id:bigint distance:int dispatch_time:int dispatch_lat:double dispatch_lng:double
    dispatch_total_rate:double dispatch_snapshot:string response_time:int accept_status:tinyint
    response_lat:double response_lng:double response_distance:double response_time_length:int
    decision_time:int decision_total_rate:double decision_result:tinyint
    decision_failure_reason:tinyint decision_msg_snapshot:string subtract_amount:int
    add_price_set:string response_snapshot:string is_assigned:tinyint route_distance:int
    route_time_length:int distance_time_length:int driver_bidding_rate:double
    driver_estimate_price:int city:string
"""

BIDDING_ACCESS = """
    datetime:string tag:string operation:string request:string result:string
"""

PRE_DISPATCH = """
    datetime:string bidding_id:bigint data:string
"""

PRICING_ROUND = """
    datetime:string order_id:bigint bidding_id:bigint round:int data:string
"""

ORDER_TRACK = """
    order_track_id:bigint order_id:bigint action_name:string username:string dateline:int
    operator:string ip:string extra:string add_price_amount:int create_time:int update_time:int
    operation:string
"""

DRIVER_API = """
    datetime:string ip_1:string ip_2:string driver_id:int
"""

ODS_ORDER = """
    service_order_id:bigint product_type_id:int fixed_product_id:int city:string create_time:int
    total_amount:float origin_amount:decimal(20,2) sharing_amount:float status:tinyint
    expect_start_time:int expect_end_time:int start_time:int end_time:int user_id:bigint
    corporate_id:bigint car_id:int driver_id:bigint driver_name:string driver_phone:string
    user_type:tinyint car_type_id:int coupon_name:string coupon_type:int source:int
    coupon_facevalue:int dependable_distance:int actual_time_length:int time_length:int
    passenger_name:string is_asap:int car_type:int car_brand:string vehicle_number:string
    invoice:int start_position:string end_position:string coupon_member_id:bigint msg:string
    comment:string reason_id:int operator_id:int last_operator:string deposit:float
    pay_amount:float is_auto_dispatch:int app_msg:string regulatepan_amount:float
    regulatedri_amount:float update_time:timestamp passenger_phone:string
    origin_sharing_amount:float pay_status:int flag:bigint confirm_time:int version:string
    app_version:string balance_status:int receipt_title:string arrival_time:int
    driver_night_amount:int highway_amount:float parking_amount:float is_night:int
    deadhead_distance:int extension:string driver_service_amount:int predict_origin_amount:int
    predict_amount:int start_latitude:double start_longitude:double compute_amount:float
    addons_amount:float expect_start_latitude:double expect_start_longitude:double
    expect_end_latitude:double expect_end_longitude:double system_distance:int mileage:int
    car_type_ids:string regulatepan_reason:string regulatedri_reason:string abnormal_mark:int
    runtime:int platform:int user_phone:string account_id:bigint rc_status:int
    corporate_dept_id:int
"""

ORDER_CHARGE = """
    service_order_id:bigint distribute_driver_amount:int distribute_company_amount:int
    distribute_yidao_amount:int distribute_snap:string driver_agent_amount:int
    is_fee_computed:tinyint is_agent:tinyint distribute_status:tinyint create_time:int
    update_time:int end_time:int balance_time:int distribute_time:int flag:int
    expect_driver_agent_amount:int company_receipt_amount:int driver_laowu_amount:int
    rc_status:tinyint distribute_labour_company_amount:int distribute_fund_amount:int
    labour_company_receipt_amount:int
"""
DEVICE = """
    device_id:string user_id:bigint status:int user_type:int update_time:bigint app_version:string
    os_type:string os_version:string mac_address:string device_type:string device_serialno:string
    exception_flag:string os_name:string app_series:string dt:int
"""

RISK_ORDER = """
    service_order_id:bigint city:string driver_id:bigint user_id:bigint price:double
    create_time:timestamp complete_time:timestamp car_type:string company:string
    product_type:string charge_distance:double charge_time_length:double system_distance:double
    mileage:double actual_time_length:double is_rc:string
"""

# Line patterns of the log files (the whole line must match).

ACCESS_PATTERN = r".*\[(.+)\]\s(\w+)\s([/\w]+)\s(\{.+\})[-\s\w.\d]+(\{.+\}).*"
PRE_PATTERN = r'.*(\d{4}-\d{2}-\d{2}_\d{2}:\d{2}:\d{2}) - (\d*) - (\{.*\})"\}'
ROUND_PATTERN = r'.*(\d{4}-\d{2}-\d{2}_\d{2}:\d{2}:\d{2}) (\d+) (\d+) (\d+) (\{.*\})"\}'
API_PATTERN = (
    r".*(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})  (\d+\.\d+\.\d+\.\d+)   -   "
    r"(\d+\.\d+\.\d+\.\d+)   [\w_-]*   -   (\d*)   .*"
)

CONTROL_A = "\u0001"
TWO_PIPES = "||"


@dataclass(frozen=True)
class LogSource:
    """How one landed log becomes one typed table."""

    schema: Fields
    key: str
    sep: str | None = None
    pattern: str | None = None
    change_log: bool = False
    by_hour: bool = False
    rename: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class ImportSource:
    """How one daily tab-separated export becomes one table."""

    schema: Fields
    file_name: str
    keep_versions: bool = False


LOGS: dict[str, LogSource] = {
    "service_order": LogSource(
        fields(SERVICE_ORDER), "service_order_id", sep=CONTROL_A, change_log=True
    ),
    "service_order_ext": LogSource(
        fields(SERVICE_ORDER_EXT), "service_order_id", sep=CONTROL_A, change_log=True
    ),
    "dispatch_info": LogSource(fields(DISPATCH_INFO), "service_order_id", sep=TWO_PIPES),
    "dispatch_detail": LogSource(
        fields(DISPATCH_DETAIL), "service_order_id", sep=TWO_PIPES, by_hour=True
    ),
    "bidding_access": LogSource(
        fields(BIDDING_ACCESS),
        "request",
        pattern=ACCESS_PATTERN,
        rename=(("datetime", "timestamp"),),
    ),
    "pre_dispatch": LogSource(fields(PRE_DISPATCH), "bidding_id", pattern=PRE_PATTERN),
    "system_dispatch": LogSource(fields(PRICING_ROUND), "order_id", pattern=ROUND_PATTERN),
    "personal_dispatch": LogSource(fields(PRICING_ROUND), "order_id", pattern=ROUND_PATTERN),
    "order_track": LogSource(fields(ORDER_TRACK), "order_id", sep=CONTROL_A),
    "driver_api_access_gray": LogSource(fields(DRIVER_API), "datetime", pattern=API_PATTERN),
}

# An export has the columns of the change log without its operation, then its day.
_DAY: Fields = [("dt", "string")]

IMPORTS: dict[str, ImportSource] = {
    "fo_service_order": ImportSource(
        without(fields(SERVICE_ORDER), "operation") + _DAY, "fo_service_order", True
    ),
    "fo_service_order_ext": ImportSource(
        without(fields(SERVICE_ORDER_EXT), "operation") + _DAY, "fo_service_order_ext", True
    ),
    "ods_service_order": ImportSource(fields(ODS_ORDER) + _DAY, "ods_service_order"),
    "ods_service_order_charge": ImportSource(
        fields(ORDER_CHARGE) + _DAY, "ods_service_order_charge"
    ),
}


def ods_schema(name: str) -> str:
    """Columns and types of a converted log, with its partition columns."""
    source = LOGS[name]
    new_names = dict(source.rename)
    columns = [(new_names.get(n, n), t) for n, t in source.schema]
    hour: Fields = [("hour", "int")] if source.by_hour else []
    return ", ".join(f"`{n}` {t}" for n, t in [*columns, ("dt", "int"), *hour])
