"""Small literal inputs of the tests, written for them."""

# One row per validation rule among valid rows.
DIRTY_CUSTOMERS = """CustomerID,Name,HasLoan
301,Lena Brook,Yes
302,Milo Hart,No
303,,Yes
304,Nia Cole,MAYBE
,Omar Reyes,Yes
306,Pia Sund,No
307,Quentin Ash,Yes
XX9,Rosa Lund,Yes
309,Sven Ek,None
310,Tess Moor,77
"""

DIRTY_ACCOUNTS = """AccountID,CustomerID,Balance,AccountType
C-01,301,5000.00,Savings
C-02,302,15000.00,Savings
C-03,306,25000.00,Savings
C-04,307,25000.00,Savings
C-05,309,8000.00,Checking
C-06,306,,Savings
C-07,302,N/A,Savings
C-08,302,null,Checking
C-09,307,12x,Savings
C-10,307,-3.50,Savings
,301,100.00,Savings
C-12,,100.00,Savings
C-13,XX9,100.00,Savings
C-14,301,100.00,
C-15,301,100.00,Bonds
C-16,303,9000.00,Savings
"""

# Padded ids, mixed-case types and flags, tier edges, customers with two
# accounts.
EDGE_CUSTOMERS = """CustomerID,Name,HasLoan
201,Ana Forte,Yes
202,Ben Okoro,No
203,Cleo Marsh,None
 204 ,  Dara Quill  ,Yes
205  ,Eli Voss,No
206,FAYE NORD,yes
207,gus lind,YES
208,Hana Ito,no
209,Ivo Petrov,none
210,June Achebe,Yes
211,Kai Moreno,None
"""

EDGE_ACCOUNTS = """AccountID,CustomerID,Balance,AccountType
B-01,201,4200.00,Savings
B-02,204,7777.70,Savings
B-03,208,9999.99,Savings
B-04,202,10000.00,Savings
B-05,205,14500.00,Savings
B-06,209,19999.99,Savings
B-07,203,20000.00,Savings
B-08,207,31000.00,Savings
B-09,206,12500.00,Checking
B-10,210,18000.00,checking
B-11, 211 ,22500.00, Savings 
B-12,201,10000.01,Savings
B-13,206,19998.00,SAVINGS
"""


def write(dirpath: str, name: str, text: str) -> str:
    import os
    p = os.path.join(dirpath, name)
    os.makedirs(dirpath, exist_ok=True)
    with open(p, "w") as f:
        f.write(text)
    return p
