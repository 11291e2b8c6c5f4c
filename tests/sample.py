"""A small set of raw extracts holding every kind of dirt the cleaning must meet."""

from __future__ import annotations

from pathlib import Path

RAW = {
    "customers": """customer_id,region,segment,signup_date
C1,North,SMB,2022-09-08
C2,South,"  Mid-Market\t",
C1,North,SMB,2022-09-08
C3,West,smb,NA
C4,,"Big, Corp",2024-02-29
""",
    "products": """product_id,category,base_price,margin_pct
P1, home-decor ,1000,0.25
P2,FASHION,200,
P3,electronics,300,0.30
P4,Home,400,0.20
P1,HOME,1,0.99
""",
    "orders": """order_id,order_date,customer_id,product_id,region,order_value,discount_pct
O1,2024-01-05,C1,P1,North,100.10,0.10
O2,2024-01-05,C1,P1,North,200.20,0.20
O2,2024-01-06,C2,P2,South,9.99,0.90
O3,2024-01-05,C1,P1,North,300.30,
O4,2024-01-07,C2,P2,South,,0.10
O4,2024-01-07,C2,P2,South,500,0.10
O5,2024-02-10,C2,P2,South,50000,0.05
O6,2024-02-10,C2,P2,South,50000.01,0.05
O7,2024-02-11,C3,P9,West,70,null
O8,2024-03-12,C3,P3,West,80.005,0
O9,2024-03-13,C4,P4,,10,0.5
""",
    "web_events": """event_date,region,event_type,count
2024-01-01,North,VISIT,100.0
2024-01-01,North, visit ,50
2024-01-01,North,Add_To_Cart,30.9
2024-01-01,North,purchase,6
2024-01-01,South,Purchase,4
2024-01-01,South,Refund,9
2024-01-02,West,visit,
2024-01-02,West,visit,20
2024-01-02,West,visit,20
""",
    "targets": """month,region,target_revenue
2024-01-01,North,500.00
2024/01/01,North,999.00
2024-02-01,South,40000
2024/03/01,West,100.01
2024-03-01,East,7
""",
}


def write_raw(folder: Path) -> str:
    for name, text in RAW.items():
        (folder / f"{name}_raw.csv").write_text(text)
    return str(folder)
