"""Natural keys of the receipt model.

Fixed values: these column names are the published table contract.
"""

STORE = "RetailStoreID"
WORKSTATION = "WorkstationID"
SEQUENCE = "SequenceNumber"
RECEIPT_TIME = "ReceiptDateTime"
RECEIPT_NUMBER = "ReceiptNumber"
LINE_NUMBER = "LineItemSequenceNumber"

#: one transaction
RECEIPT = [STORE, WORKSTATION, SEQUENCE, RECEIPT_TIME]
#: one transaction, for tables that carry no sequence number
RECEIPT_BY_NUMBER = [STORE, WORKSTATION, RECEIPT_NUMBER, RECEIPT_TIME]
#: one receipt position
LINE = RECEIPT + [LINE_NUMBER]
LINE_BY_NUMBER = RECEIPT_BY_NUMBER + [LINE_NUMBER]
#: one lane on one business day
LANE = [STORE, WORKSTATION]
