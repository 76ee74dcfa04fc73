import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import fresh_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8)
    yield s


@pytest.fixture()
def workdir(spark):
    """A new folder under the session's shared work folder for each test."""
    return fresh_dir(spark, "test")


def write_text(path: str, header: str, rows: list[str]) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(r + "\n")
    return path


ORDERS_HEADER = ("order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,"
                 "days_since_prior_order")
LINES_HEADER = "order_id,product_id,add_to_cart_order,reordered"


def order_row(oid: int, eval_set: str = "prior", user: int = 1, number: int = 1,
              dow: int = 1, hour: int = 10, days: str = "7.0") -> str:
    return f"{oid},{user},{eval_set},{number},{dow},{hour},{days}"


def line_row(oid: int, pid: int, cart: int = 1, reordered: int = 0) -> str:
    return f"{oid},{pid},{cart},{reordered}"


def write_raw(root: str, orders: list[str], lines: list[str],
              products: list[str] | None = None, aisles: list[str] | None = None,
              departments: list[str] | None = None) -> str:
    """Raw zone of single CSV files (paths end in .csv like the real drop)."""
    local = root[len("file:"):] if root.startswith("file:") else root
    write_text(f"{local}/orders.csv", ORDERS_HEADER, orders)
    write_text(f"{local}/order_products__prior.csv", LINES_HEADER, lines)
    write_text(f"{local}/products.csv", "product_id,product_name,aisle_id,department_id",
               products if products is not None else
               ['1,"Salt ""Fine"", Sea",1,1', "2,Bananas,2,1", "3,Milk,2,2"])
    write_text(f"{local}/aisles.csv", "aisle_id,aisle",
               aisles if aisles is not None else ["1,spices", "2,fresh"])
    write_text(f"{local}/departments.csv", "department_id,department",
               departments if departments is not None else ["1,pantry", "2,dairy"])
    return root
