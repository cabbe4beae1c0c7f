"""Names that several test modules share."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from adspend import schemas
from adspend.sources.tables import AdInputs

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
RUN = dt.date(2024, 1, 15)


def D(x) -> Decimal | None:
    return None if x is None else Decimal(str(x))


class Inputs:
    """Builds small hand-written ``AdInputs``; every table defaults to empty."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {name: [] for name in schemas.INPUT_SCHEMAS}

    def vertical(self, advertiser_id, type_="BUILDING", raa_name="raa"):
        self.rows["advertiser_vertical"].append((advertiser_id, type_, raa_name))
        return self

    def user(self, uid, account_budget=None, status=1, company="Acme", product="managed", country="us",
             credits=1000, debits=500, vertical=True):
        self.rows["users"].append((uid, status, company, product, country, D(credits), D(debits),
                                   D(account_budget)))
        if vertical:
            self.vertical(uid)
        return self

    def campaign(self, camp_id, user_id, budget, cost_today, cpc, camp_type="pjl", status="yes",
                 start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 31)):
        self.rows["campaigns"].append((camp_id, user_id, f"camp-{camp_id}", camp_type, status, start, end,
                                       D(budget), D(cost_today), D(cpc)))
        return self

    def click(self, record_id, camp_id, cost=0.2, main=True, billable=True, day=RUN, batches=()):
        self.rows["ad_clicks"].append((record_id, camp_id, day, 30647 if main else 11111,
                                       99 if billable else 1, D(cost)))
        for b in batches:
            self.rows["click_batches"].append((record_id, b))
        return self

    def batch(self, batch_id, feed, publisher=30647, day=RUN):
        self.rows["export_batches"].append((batch_id, feed, day, publisher))
        return self

    def exported(self, camp_id, batch_id):
        self.rows["export_campaign_stats"].append((camp_id, batch_id))
        return self

    def policy(self, policy, entity, id_, price=None):
        self.rows["client_policy"].append((policy, entity, id_, price))
        return self

    def build(self) -> AdInputs:
        frames = {name: self.spark.createDataFrame(rows, schemas.INPUT_SCHEMAS[name])
                  for name, rows in self.rows.items()}
        return AdInputs(**frames)
