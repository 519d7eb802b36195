"""Declared schemas; nothing is inferred at ingestion."""
from __future__ import annotations

ORDERS_RAW = ("order_id string, customer_id string, customer_email string, region string, channel string, "
              "order_status string, order_ts string, currency string, promo_codes array<string>, "
              "ship_address struct<city:string,state:string>, ingested_at string")
ORDER_ITEMS_RAW = ("order_id string, line_no int, sku string, department string, qty int, "
                   "unit_price double, discount_pct double")
VERSIONED_ORDERS = ("order_id bigint, customer_id bigint, region string, department string, status string, "
                    "order_amount decimal(10,2), order_ts timestamp")
CDR_EVENTS = ("cdr_id string, market string, event_ts timestamp, event_date date, event_hour int, a_number string, "
              "b_number string, service_type string, tariff_plan_id string, duration_sec int, bytes_total bigint, "
              "charged_units bigint, charge_amount double, rated_flag string, quality_flag string, "
              "source_ts timestamp, subscriber_id string, cell_id string, call_end_cause string, is_onnet boolean")
PARTNER_LEG = ("a_number string, b_number string, event_ts timestamp, duration_sec int, charged_units int, "
               "charge_amount decimal(18,5)")
CDC_ENVELOPE = ("op string, ts_ms bigint, source struct<table:string,lsn:bigint,ts_ms:bigint>, "
                "before string, after string")
LEDGER = ("transaction_id string, account_id string, amount decimal(18,2), currency string, tx_type string, "
          "status string, event_timestamp timestamp, source_lsn bigint, is_deleted boolean")
METER_READINGS = "LCLid string, tstp string, energy string"
SCORES = ["subscriber_id", "churn_probability"]
