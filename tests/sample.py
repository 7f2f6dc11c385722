"""Sample input with known results, and helpers to build small tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tillbook.plans import jobs
from tillbook.sources import Layers, landing

# The sample files. One order comes twice, one has no quantity.
CUSTOMERS = """\
customer_id,first_name,last_name,email,city,country,signup_date
1,Aarav,Sharma,aarav.sharma@example.com,Hyderabad,India,2024-01-15
2,Priya,Nair,priya.nair@example.com,Bengaluru,India,2024-02-03
3,Rohan,Mehta,rohan.mehta@example.com,Mumbai,India,2024-02-20
4,Sara,Khan,sara.khan@example.com,Delhi,India,2024-03-11
5,Vikram,Reddy,vikram.reddy@example.com,Hyderabad,India,2024-03-28
6,Ananya,Iyer,ananya.iyer@example.com,Chennai,India,2024-04-05
7,Kabir,Singh,kabir.singh@example.com,Pune,India,2024-04-19
8,Meera,Joshi,meera.joshi@example.com,Ahmedabad,India,2024-05-02
"""

PRODUCTS = """\
product_id,product_name,category,unit_price
101,Wireless Mouse,Electronics,799.00
102,Mechanical Keyboard,Electronics,2499.00
103,USB-C Hub,Electronics,1299.00
104,Notebook A5,Stationery,149.00
105,Gel Pen Pack,Stationery,99.00
106,Desk Lamp,Home,1199.00
107,Coffee Mug,Home,349.00
108,Water Bottle,Home,499.00
"""

ORDERS = """\
order_id,customer_id,product_id,quantity,order_ts,status
1001,1,101,2,2024-05-01 10:22:00,COMPLETED
1002,2,104,5,2024-05-01 11:05:00,COMPLETED
1003,1,102,1,2024-05-03 09:15:00,COMPLETED
1004,3,106,1,2024-05-04 14:40:00,CANCELLED
1005,4,105,10,2024-05-05 16:10:00,COMPLETED
1006,5,101,1,2024-05-06 12:00:00,COMPLETED
1007,2,103,2,2024-05-08 18:30:00,COMPLETED
1008,6,107,3,2024-05-09 08:45:00,COMPLETED
1008,6,107,3,2024-05-09 08:45:00,COMPLETED
1009,7,108,4,2024-05-10 19:20:00,COMPLETED
1010,1,105,6,2024-05-12 13:05:00,COMPLETED
1011,8,102,1,2024-05-13 10:00:00,PENDING
1012,3,101,2,2024-05-15 15:30:00,COMPLETED
1013,5,106,1,2024-05-16 11:11:00,COMPLETED
1014,2,108,,2024-05-18 09:50:00,COMPLETED
1015,4,103,1,2024-05-20 17:25:00,COMPLETED
"""


def write_files(folder: Path) -> dict[str, str]:
    folder.mkdir(exist_ok=True)
    paths = {}
    for table, text in (("customers", CUSTOMERS), ("products", PRODUCTS), ("orders", ORDERS)):
        file = folder / f"{table}.csv"
        file.write_text(text)
        paths[table] = str(file)
    return paths


def land(spark: SparkSession, layers: Layers) -> None:
    """Empty layers, then the sample files."""
    jobs.set_up(spark, layers)
    paths = write_files(Path(layers.root) / "incoming")
    landing.load_csv(spark, layers, "customers", paths["customers"])
    landing.load_csv(spark, layers, "products", paths["products"])
    landing.load_csv(spark, layers, "orders", paths["orders"], on_error=landing.LENIENT)
    jobs.stage_dimensions(spark, layers)


def values(df: DataFrame) -> list[tuple]:
    """Rows in order, each value as text."""
    return [tuple(None if value is None else str(value) for value in row) for row in df.collect()]


def bag(df: DataFrame) -> list[tuple]:
    """Rows regardless of order."""
    return sorted(values(df), key=repr)
