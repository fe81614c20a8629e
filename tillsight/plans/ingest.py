"""Typed receipt tables out of the wide transaction table.

One row of the wide table is one transaction. Column names are element paths; repeated
elements are parallel arrays, elements repeated inside a line are arrays of arrays. Each
target table is described by a ``TableSpec`` and built by the same few operators.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.keys import LINE_NUMBER, RECEIPT_NUMBER, RECEIPT_TIME, SEQUENCE, STORE, WORKSTATION
from tillsight.functions.rules import Rule, first_match
from tillsight.functions.scalars import business_day, file_base_name, xor_mask, zero_to_null
from tillsight.operators.dedup import dedup_by_key, require
from tillsight.operators.flatten import named_totals, zip_explode

KEY = (STORE, WORKSTATION, SEQUENCE, RECEIPT_TIME, RECEIPT_NUMBER)
LINE_KEY = (*KEY, LINE_NUMBER)
WHOLE_ROW = ("*",)

# ---------------------------------------------------------------------------------------
# Element paths of the wide table, the published column each one becomes, and
# its type. "Name" alone means path and column are the same; {side} is Sale or Return.
# ---------------------------------------------------------------------------------------

KEY_FIELDS = """
RetailStoreID                                   long
WorkstationID                                   long
SequenceNumber                                  long
GK_ReceiptDateTime      > ReceiptDateTime       timestamp
GK_ReceiptNumber        > ReceiptNumber         long
"""

HEADER_FIELDS = """
BeginDateTime                                   string
EndDateTime                                     string
_CancelFlag             > CancelFlag            boolean
_FixVersion             > FixVersion            long
_MajorVersion           > MajorVersion          long
_MinorVersion           > MinorVersion          long
_OfflineFlag            > OfflineFlag           boolean
_TrainingModeFlag       > TrainingModeFlag      boolean
TillID                                          long
OperatorID__EmployeeID  > EmployeeID            long
CurrencyCode                                    string
GK_LocationID           > LocationID            long
GK_ReceiptReturnedFlag  > ReceiptReturnedFlag   boolean
GK_OperatorBypassApproval_SequenceNumber         > OperatorBypassApprovalSequenceNumber long
GK_OperatorBypassApproval_ApproverID__EmployeeID > ApproverEmployeeID long
GK_FunctionLog_GK_StoreInfoID                    > FunctionLogStoreInfoID long
Status                                          string
InputFileName           > xmlfilename           string
"""

#: marker path -> transaction type, in order of precedence
TYPE_MARKERS = {
    "ControlTransaction__Version": "ControlTransaction",
    "GK_FunctionLog_GK_StoreInfoID": "FunctionLog",
    "RetailTransaction__Version": "RetailTransaction",
    "TenderControlTransaction__Version": "TenderControlTransaction",
}

CONTROL_FIELDS = """
ControlTransaction_OperatorSignOn_StartDateTimestamp       > SignOnStartDateTimestamp  string
ControlTransaction_OperatorSignOff_StartDateTimestamp      > SignOffStartDateTimestamp string
ControlTransaction_OperatorSignOff_GK_ForcedSignOffFlag    > ForcedSignOffFlag         boolean
ControlTransaction_NoSale                                  > NoSale                    string
ControlTransaction_ReasonCode                              > ReasonCode                string
ControlTransaction_POSEOD_StartDateTimestamp               > StartDateTimestamp        string
"""

#: column whose presence gives the kind of a control transaction, in order of precedence
CONTROL_KINDS = {
    "SignOnStartDateTimestamp": "OperatorSignOn",
    "SignOffStartDateTimestamp": "OperatorSignOff",
    "NoSale": "NoSale",
    "StartDateTimestamp": "SessionSettle",
}
OTHER_CONTROL = "SystemProgram"

FUNCTIONLOG_FIELDS = """
GK_FunctionLog_GK_StoreInfoID   > StoreInfoID   long
GK_FunctionLog_GK_FunctionID    > FunctionID    long
GK_FunctionLog_GK_FunctionName  > FunctionName  string
"""
FUNCTIONLOG_ARRAYS = """
GK_FunctionLog_GK_ParameterList_GK_Parameter_GK_ParameterName  > ParameterName  string
GK_FunctionLog_GK_ParameterList_GK_Parameter_GK_ParameterValue > ParameterValue string
"""

LINE_FIELD = """
RetailTransaction_LineItem_SequenceNumber > LineItemSequenceNumber long
"""

LINEITEM_ARRAYS = LINE_FIELD + """
RetailTransaction_LineItem__EntryMethod          > EntryMethod            string
RetailTransaction_LineItem__VoidFlag             > VoidFlag               boolean
RetailTransaction_LineItem_Tax__TaxSubType       > TaxSubType             string
RetailTransaction_LineItem_Tax_TaxableAmount__TaxIncludedInTaxableAmountFlag > TaxIncludedInTaxableAmountFlag boolean
RetailTransaction_LineItem_Tax_TaxableAmount__VALUE > TaxableAmount       double
RetailTransaction_LineItem_Tax_Amount            > Amount                 double
RetailTransaction_LineItem_Tax_Percent           > TaxPercent             double
RetailTransaction_LineItem_Tax_GK_TaxGroupID     > TaxGroupID             long
RetailTransaction_LineItem_Tax_GK_NegativeAmountFlag > NegativeAmountFlag boolean
RetailTransaction_LineItem_GK_DirectVoidFlag     > DirectVoidFlag         boolean
RetailTransaction_LineItem_Tax__TaxType          > TaxType                string
RetailTransaction_LineItem_BeginDateTime         > LineItemBeginDateTime  timestamp
"""

LOYALTY_ARRAYS = LINE_FIELD + """
RetailTransaction_LineItem_LoyaltyReward_PromotionID      > PromotionID   string
RetailTransaction_LineItem_LoyaltyReward_ReasonCode       > ReasonCode    long
RetailTransaction_LineItem_LoyaltyReward_GK_PointsAwarded > PointsAwarded double
RetailTransaction_LineItem_LoyaltyReward_GK_PriceDerivationRule_PriceDerivationRuleID   > PriceDerivationRuleID string
RetailTransaction_LineItem_LoyaltyReward_GK_PriceDerivationRule_Eligibility__Type       > EligibilityType string
RetailTransaction_LineItem_LoyaltyReward_GK_PriceDerivationRule_Eligibility_ReferenceID > ReferenceID long
RetailTransaction_LineItem_LoyaltyReward_GK_PriceDerivationRule_Amount                  > Amount double
RetailTransaction_LineItem_LoyaltyReward_GK_PriceDerivationRule_GK_Origin               > Origin long
RetailTransaction_LineItem_LoyaltyReward_GK_PriceDerivationRule_GK_AppliedQuantity      > AppliedQuantity double
RetailTransaction_LineItem_LoyaltyReward_GK_PriceDerivationRule_GK_RuleDescription      > RuleDescription string
RetailTransaction_LineItem_LoyaltyReward_GK_ItemLink      > ItemLink      long
"""

HEADER_ADDON_ARRAYS = """
GK_ReceiptHeaderAddonList_GK_Addon_GK_AddonPos > AddonPos   long
GK_ReceiptHeaderAddonList_GK_Addon_GK_Key      > AddonKey   string
GK_ReceiptHeaderAddonList_GK_Addon_GK_Value    > AddonValue string
"""

POSITION_ADDON_NESTED = """
RetailTransaction_LineItem_{side}_GK_ReceiptPositionAddonList_GK_Addon_GK_AddonPos > AddonPos   long
RetailTransaction_LineItem_{side}_GK_ReceiptPositionAddonList_GK_Addon_GK_Key      > AddonKey   string
RetailTransaction_LineItem_{side}_GK_ReceiptPositionAddonList_GK_Addon_GK_Value    > AddonValue string
"""

CUSTOMER_ARRAYS = """
RetailTransaction_GK_Customer_AccountNumber              > AccountNumber           long
RetailTransaction_GK_Customer_GK_CustomerType            > CustomerType            string
RetailTransaction_GK_Customer_GK_CustomerTypeDescription > CustomerTypeDescription string
RetailTransaction_GK_Customer_GK_CustomerGenericFlag     > CustomerGenericFlag     boolean
RetailTransaction_GK_Customer_GK_CustomerRequisationRequiredFlag > CustomerRequisationRequiredFlag boolean
RetailTransaction_GK_Customer_GK_CustomerBuyerRequiredFlag   > CustomerBuyerRequiredFlag   boolean
RetailTransaction_GK_Customer_GK_CustomerContactRequiredFlag > CustomerContactRequiredFlag boolean
RetailTransaction_GK_Customer_GK_CustomerGroup           > CustomerGroup           string
"""
CUSTOMER_ADDRESS = "RetailTransaction_GK_Customer_Address_AddressLine"

MODIFIER_ARRAYS = LINE_FIELD + """
RetailTransaction_LineItem_{side}_RetailPriceModifier_Amount__VALUE > AmountValue double
"""
MODIFIER_NESTED = """
RetailTransaction_LineItem_{side}_RetailPriceModifier_SequenceNumber > PriceModifierSequenceNumber long
RetailTransaction_LineItem_{side}_RetailPriceModifier_Amount__Action > AmountAction  string
RetailTransaction_LineItem_{side}_RetailPriceModifier_PromotionID    > PromotionID   string
RetailTransaction_LineItem_{side}_RetailPriceModifier_PreviousPrice  > PreviousPrice double
RetailTransaction_LineItem_{side}_RetailPriceModifier_NewPrice       > NewPrice      double
RetailTransaction_LineItem_{side}_RetailPriceModifier_{reason}       > ReasonCode    string
RetailTransaction_LineItem_{side}_RetailPriceModifier_GK_RebateID    > RebateID      string
"""
MODIFIER_REASON = {"Return": "ReasonCode", "Sale": "GK_ReasonCode__VALUE"}

REBATE_NESTED = """
RetailTransaction_LineItem_{side}_RetailPriceModifier_SequenceNumber > RetailPriceModifierSequenceNumber long
RetailTransaction_LineItem_{side}_RetailPriceModifier_NewPrice       > NewPrice double
RetailTransaction_LineItem_{side}_RetailPriceModifier_PriceDerivationRule_GK_RuleDescription > RuleDescription string
"""
REBATE_FLAG = {"Return": 0, "Sale": 1}

ITEM_ARRAYS = LINE_FIELD + """
RetailTransaction_LineItem_{side}__ItemType                         > ItemType          string
RetailTransaction_LineItem_{side}_POSIdentity__POSIDType            > POSIDType         string
RetailTransaction_LineItem_{side}_POSIdentity_POSItemID             > POSItemID         decimal(22,0)
RetailTransaction_LineItem_{side}_Tax_TaxableAmount__VALUE          > TaxableAmount     double
RetailTransaction_LineItem_{side}_Tax_Amount                        > TaxAmount         double
RetailTransaction_LineItem_{side}_ItemID                            > ItemID            long
RetailTransaction_LineItem_{side}_MerchandiseHierarchy__VALUE       > MerchandiseHierarchyLevel long
RetailTransaction_LineItem_{side}_Description                       > Description       string
RetailTransaction_LineItem_{side}_TaxIncludedInPriceFlag            > TaxIncludedInPriceFlag boolean
RetailTransaction_LineItem_{side}_RegularSalesUnitPrice             > RegularSalesUnitPrice double
RetailTransaction_LineItem_{side}_ExtendedAmount                    > ExtendedAmount    double
RetailTransaction_LineItem_{side}_Quantity__UnitOfMeasureCode       > UnitOfMeasureCode string
RetailTransaction_LineItem_{side}_Quantity__VALUE                   > Quantity          double
RetailTransaction_LineItem_{side}_Quantity__Units                   > Units             double
RetailTransaction_LineItem_{side}_GK_ExtendedGrossAmount            > ExtendedGrossAmount double
RetailTransaction_LineItem_{side}_GK_MerchandiseStructureItemFlag   > MerchandiseStructureItemFlag boolean
RetailTransaction_LineItem_{side}_ItemLink                          > {side}ItemLink    long
RetailTransaction_LineItem_{side}_GK_ItemLink__LinkType             > ItemLinkType      string
RetailTransaction_LineItem_{side}_GK_ItemLink__VALUE                > ItemLink          long
RetailTransaction_LineItem_{side}_GK_SpecialPriceDescription        > SpecialPriceDescription long
"""
RETURN_ONLY_ARRAYS = """
RetailTransaction_LineItem_Return_Disposal__Method                  > DisposalMethod    string
RetailTransaction_LineItem_Return_TransactionLink_SequenceNumber    > TransactionLinkSequenceNumber long
RetailTransaction_LineItem_Return_TransactionLink__ReasonCode       > TransactionLinkReasonCode string
"""
ITEM_TAX_NESTED = """
RetailTransaction_LineItem_{side}_Tax__TaxSubType                   > TaxSubType        string
RetailTransaction_LineItem_{side}_Tax_TaxableAmount__TaxIncludedInTaxableAmountFlag > TaxIncludedInTaxableAmountFlag boolean
RetailTransaction_LineItem_{side}_Tax_Percent                       > TaxPercent        double
RetailTransaction_LineItem_{side}_Tax_GK_TaxGroupID                 > TaxGroupID        long
RetailTransaction_LineItem_{side}_Tax__TaxType                      > TaxType           string
"""

RETAILHEADER_FIELDS = """
RetailTransaction__OutsideSalesFlag                   > OutsideSalesFlag                 boolean
RetailTransaction__SplitCheckFlag                     > SplitCheckFlag                   boolean
RetailTransaction__TransactionStatus                  > TransactionStatus                string
RetailTransaction__TypeCode                           > TypeCode                         string
RetailTransaction_ReceiptDateTime                     > RetailTransactionReceiptDateTime string
RetailTransaction_GK_AmendmentFlag                    > AmendmentFlag                    boolean
RetailTransaction_GK_NegativeTotalFlag                > NegativeTotalFlag                boolean
RetailTransaction_TransactionLink_RetailStoreID       > TransactionLinkRetailStoreID     long
RetailTransaction_TransactionLink_WorkstationID       > TransactionLinkWorkstationID     long
RetailTransaction_TransactionLink_SequenceNumber      > TransactionLinkSequenceNumber    long
RetailTransaction_TransactionLink_BeginDateTime       > TransactionLinkBeginDateTime     string
RetailTransaction_TransactionLink_GK_ReceiptDateTime  > TransactionLinkReceiptDateTime   timestamp
RetailTransaction_TransactionLink_GK_ReceiptNumber    > TransactionLinkReceiptNumber     long
RetailTransaction_TransactionLink__ReasonCode         > TransactionLinkReasonCode        string
"""
TOTAL_NAMES = "RetailTransaction_Total__TotalType"
TOTAL_VALUES = "RetailTransaction_Total__VALUE"
#: published amount -> its name in the list of totals
TOTALS = {
    "TransactionGrandAmount": "TransactionGrandAmount",
    "TransactionTaxAmount": "TransactionTaxAmount",
    "NegativeTransactionTaxAmount": "GK:NegativeTransactionTaxAmount",
}

TENDER_ARRAYS = LINE_FIELD + """
RetailTransaction_LineItem_Tender__TenderType                         > TenderType            string
RetailTransaction_LineItem_Tender_TenderID                            > TenderID              string
RetailTransaction_LineItem_Tender__TypeCode                           > TypeCode              string
RetailTransaction_LineItem_Tender_Amount__VALUE                       > Amount                double
RetailTransaction_LineItem_Tender_CashBack                            > Cashback              double
RetailTransaction_LineItem_Tender_TenderChange_Amount                 > TenderChangeAmount    double
RetailTransaction_LineItem_Tender_Authorization__ElectronicSignature  > ElectronicSignature   boolean
RetailTransaction_LineItem_Tender_Authorization__ForceOnline          > ForceOnline           boolean
RetailTransaction_LineItem_Tender_Authorization__HostAuthorized       > HostAuthorized        boolean
RetailTransaction_LineItem_Tender_Authorization_RequestedAmount       > RequestedAmount       double
RetailTransaction_LineItem_Tender_Authorization_AuthorizationCode     > AuthorizationCode     long
RetailTransaction_LineItem_Tender_Authorization_ReferenceNumber       > ReferenceNumber       long
RetailTransaction_LineItem_Tender_Authorization_MerchantNumber        > MerchantNumber        long
RetailTransaction_LineItem_Tender_Authorization_ProviderID            > ProviderID            long
RetailTransaction_LineItem_Tender_Authorization_AuthorizationDateTime > AuthorizationDateTime string
RetailTransaction_LineItem_Tender_Authorization_AuthorizingTermID     > AuthorizingTermID     long
RetailTransaction_LineItem_Tender_CreditDebit__CardType               > CardType              string
RetailTransaction_LineItem_Tender_CreditDebit_IssuerIdentificationNumber > IssuerIdentificationNumber long
RetailTransaction_LineItem_Tender_CreditDebit_PrimaryAccountNumber    > PrimaryAccountNumber  long
RetailTransaction_LineItem_Tender_CreditDebit_IssueSequence           > IssueSequence         long
RetailTransaction_LineItem_Tender_CreditDebit_ExpirationDate          > ExpirationDate        string
RetailTransaction_LineItem_Tender_CreditDebit_ReconciliationCode      > ReconciliationCode    long
RetailTransaction_LineItem_Tender_CreditDebit_StartDate               > StartDate             string
RetailTransaction_LineItem_Tender_CreditDebit_GK_TerminalReceiptNumber > TerminalReceiptNumber long
RetailTransaction_LineItem_Tender_CreditDebit_GK_TraceNumber          > TraceNumber           long
RetailTransaction_LineItem_Tender_Voucher_SerialNumber                > SerialNumber          long
"""
TENDER_NESTED = """
RetailTransaction_LineItem_Tender_TenderChange__TenderType            > TenderChangeType      string
RetailTransaction_LineItem_Tender_TenderChange_TenderID               > TenderChangeID        string
"""

LOAN_FIELDS = """
TenderControlTransaction_TenderLoan__TenderType              > TenderLoanType          string
TenderControlTransaction_TenderLoan_Totals_Amount__VALUE     > TenderLoanTotalAmount   double
TenderControlTransaction_TenderLoan_Totals_Amount__Currency  > TenderLoanTotalCurrency string
"""

PICKUP_FIELDS = """
TenderControlTransaction_TenderPickup_Reason > TenderPickUpReason string
"""
PICKUP_ARRAYS = """
TenderControlTransaction_TenderPickup_Totals__TenderType                   > TenderType          string
TenderControlTransaction_TenderPickup_Totals_TenderTotal_Amount__VALUE     > TenderTotalAmount   double
TenderControlTransaction_TenderPickup_Totals_TenderTotal_Amount__Currency  > TenderTotalCurrency string
TenderControlTransaction_TenderPickup_Totals_TenderTotal_Count             > TenderTotalCount    long
"""

SAFESETTLE_FIELDS = """
TenderControlTransaction_SafeSettle_TenderOpenBalanceTotalAmount  > TenderOpenBalanceTotalAmount  double
TenderControlTransaction_SafeSettle_TenderCloseBalanceTotalAmount > TenderCloseBalanceTotalAmount double
TenderControlTransaction_SafeSettle_TenderLoanTotalAmount         > TenderLoanTotalAmount         double
TenderControlTransaction_SafeSettle_TotalTenderLoanCount          > TotalTenderLoanCount          long
TenderControlTransaction_SafeSettle_TenderPickupTotalAmount       > TenderPickupTotalAmount       double
TenderControlTransaction_SafeSettle_TotalTenderPickupCount        > TotalTenderPickupCount        long
TenderControlTransaction_SafeSettle_TenderDepositTotalAmount      > TenderDepositTotalAmount      double
TenderControlTransaction_SafeSettle_TenderReceiptTotalAmount      > TenderReceiptTotalAmount      double
"""

TILLSETTLE_FIELDS = """
TenderControlTransaction_TillSettle_TransactionCount               > TransactionCount               long
TenderControlTransaction_TillSettle_TotalNetSalesAmount            > TotalNetSalesAmount            double
TenderControlTransaction_TillSettle_TotalTaxAmount                 > TotalTaxAmount                 double
TenderControlTransaction_TillSettle_TotalGrossSalesExemptTaxAmount > TotalGrossSalesExemptTaxAmount double
TenderControlTransaction_TillSettle_GrossPositiveAmount            > GrossPositiveAmount            double
TenderControlTransaction_TillSettle_GrossNegativeAmount            > GrossNegativeAmount            double
TenderControlTransaction_TillSettle_TotalMeasures_SaleLineItemCount       > SaleLineItemCount       long
TenderControlTransaction_TillSettle_TotalMeasures_NoSaleTransactionCount  > NoSaleTransactionCount  long
TenderControlTransaction_TillSettle_TotalMeasures_LineItemOverrideCount   > LineItemOverrideCount   long
TenderControlTransaction_TillSettle_TotalMeasures_WeightedLineItemCount   > WeightedLineItemCount   long
TenderControlTransaction_TillSettle_TotalMeasures_LineItemKeyedCount      > LineItemKeyedCount      long
TenderControlTransaction_TillSettle_TotalMeasures_LineItemKeyedPercentage > LineItemKeyedPercentage double
TenderControlTransaction_TillSettle_TotalMeasures_LineItemScannedCount    > LineItemScannedCount    long
TenderControlTransaction_TillSettle_TotalMeasures_LineItemScannedPercentage > LineItemScannedPercentage double
TenderControlTransaction_TillSettle_TotalMeasures_LineItemOpenDepartmentCount > LineItemOpenDepartmentCount long
TenderControlTransaction_TillSettle_TotalMeasures_LineItemOpenDepartmentPercentage > LineItemOpenDepartmentPercentage double
TenderControlTransaction_TillSettle_TotalMeasures_RingTime         > RingTime                       double
TenderControlTransaction_TillSettle_TotalMeasures_IdleTime         > IdleTime                       double
TenderControlTransaction_TillSettle_TotalMeasures_LockTime         > LockTime                       double
TenderControlTransaction_TillSettle_TotalMeasures_TenderTime       > TenderTime                     double
"""
TILLSETTLE_ARRAYS = """
TenderControlTransaction_TillSettle_TenderSummary__TenderType                > TenderType        string
TenderControlTransaction_TillSettle_TenderSummary_Beginning_Amount__VALUE    > BeginningAmount   double
TenderControlTransaction_TillSettle_TenderSummary_Beginning_Amount__Currency > BeginningCurrency string
TenderControlTransaction_TillSettle_TenderSummary_Ending_Amount__VALUE       > EndingAmount      double
TenderControlTransaction_TillSettle_TenderSummary_Ending_Amount__Currency    > EndingCurrency    string
TenderControlTransaction_TillSettle_TenderSummary_Over_Amount__VALUE         > OverAmount        double
TenderControlTransaction_TillSettle_TenderSummary_Over_Amount__Currency      > OverCurrency      string
"""

DEPOSIT_FIELDS = """
TenderControlTransaction_PaidOut_Amount__Currency               > PaidOutCurrency   string
TenderControlTransaction_PaidOut_Amount__VALUE                  > PaidOutAmount     double
TenderControlTransaction_Deposit_Account                        > Account           string
TenderControlTransaction_Deposit_Amount                         > Amount            double
TenderControlTransaction_Deposit_BagID                          > BagID             string
TenderControlTransaction_Deposit_Description                    > Description       string
TenderControlTransaction_Deposit_Depositor__EmployeeID          > EmployeeID        long
TenderControlTransaction_Deposit_DepositDetail__TenderType      > DepositTenderType string
TenderControlTransaction_Deposit_DepositDetail_TenderTotal_Amount > TenderTotalAmount double
"""
DEPOSIT_ARRAYS = """
TenderControlTransaction_GK_PaidIn__TenderType      > PaidInTenderType string
TenderControlTransaction_GK_PaidIn__TypeCode        > PaidInTypeCode   string
TenderControlTransaction_GK_PaidIn_Amount__VALUE    > PaidInAmount     double
TenderControlTransaction_GK_PaidIn_Amount__Currency > PaidInCurrency   string
TenderControlTransaction_GK_PaidIn_Count            > PaidInCount      long
TenderControlTransaction_GK_PaidIn_Reason           > PaidInReason     string
"""

# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    path: str
    name: str
    type: str


def fields(text: str, **names: str) -> tuple[Field, ...]:
    for k, v in names.items():
        text = text.replace("{" + k + "}", v)
    out = []
    for line in text.strip().splitlines():
        words = line.replace(">", " ").split()
        if words:
            out.append(Field(words[0], words[-2], words[-1]))
    return tuple(out)


@dataclass(frozen=True)
class TableSpec:
    """Where the columns of one table come from and what makes a row of it.

    ``scalars`` occur once per transaction, ``arrays`` once per line, ``nested`` several
    times per line. ``keep_empty`` says whether transactions (lines) without any array
    entry survive. Rows lacking a ``required`` column are dropped, after deduplication if
    ``dedup_first``.
    """

    name: str
    scalars: tuple[Field, ...] = ()
    arrays: tuple[Field, ...] = ()
    nested: tuple[Field, ...] = ()
    marker: str | None = None
    keep_empty: bool = False
    keep_empty_nested: bool = False
    required: tuple[str, ...] = ()
    dedup: tuple[str, ...] | None = None
    dedup_first: bool = False

    @property
    def leaves(self) -> tuple[Field, ...]:
        return (*self.scalars, *self.arrays, *self.nested)


KEYS = fields(KEY_FIELDS)


def item_spec(side: str) -> TableSpec:
    extra = fields(RETURN_ONLY_ARRAYS) if side == "Return" else ()
    return TableSpec(
        side.lower(),
        arrays=fields(ITEM_ARRAYS, side=side) + extra,
        nested=fields(ITEM_TAX_NESTED, side=side),
        keep_empty_nested=True,
        required=("ItemType",),
        dedup=LINE_KEY,
    )


def modifier_spec(side: str) -> TableSpec:
    return TableSpec(
        "retailpricemodifier",
        arrays=fields(MODIFIER_ARRAYS, side=side),
        nested=fields(MODIFIER_NESTED, side=side, reason=MODIFIER_REASON[side]),
        required=("PriceModifierSequenceNumber",),
    )


def position_addon_spec(side: str) -> TableSpec:
    return TableSpec(
        "receiptpositionaddonlist",
        arrays=fields(LINE_FIELD),
        nested=fields(POSITION_ADDON_NESTED, side=side),
    )


def rebate_spec(side: str) -> TableSpec:
    return TableSpec(
        "salereturn_rebate", arrays=fields(LINE_FIELD), nested=fields(REBATE_NESTED, side=side)
    )


def _names(text: str) -> tuple[str, ...]:
    return tuple(f.name for f in fields(text))


SPECS = {
    s.name: s
    for s in (
        TableSpec("transactionheader", scalars=fields(HEADER_FIELDS)),
        TableSpec("controltransaction", scalars=fields(CONTROL_FIELDS),
                  marker="ControlTransaction__Version", dedup=KEY),
        TableSpec("functionlog", scalars=fields(FUNCTIONLOG_FIELDS), arrays=fields(FUNCTIONLOG_ARRAYS),
                  required=("StoreInfoID",), dedup=WHOLE_ROW),
        TableSpec("lineitem", arrays=fields(LINEITEM_ARRAYS), dedup=LINE_KEY),
        TableSpec("loyaltyreward", arrays=fields(LOYALTY_ARRAYS), dedup=LINE_KEY,
                  required=("PointsAwarded",), dedup_first=True),
        TableSpec("receiptheaderaddonlist", arrays=fields(HEADER_ADDON_ARRAYS), dedup=WHOLE_ROW),
        TableSpec("customer", arrays=fields(CUSTOMER_ARRAYS), keep_empty=True, dedup=KEY),
        TableSpec("retailtransactionheader", scalars=fields(RETAILHEADER_FIELDS),
                  marker="RetailTransaction__Version",
                  required=("RetailTransactionReceiptDateTime",), dedup=KEY),
        TableSpec("tender", arrays=fields(TENDER_ARRAYS), nested=fields(TENDER_NESTED),
                  keep_empty_nested=True, required=("TenderID",), dedup=LINE_KEY),
        TableSpec("tendercontrolloan", scalars=fields(LOAN_FIELDS), required=_names(LOAN_FIELDS),
                  dedup=KEY),
        TableSpec("tendercontrolpickup", scalars=fields(PICKUP_FIELDS), arrays=fields(PICKUP_ARRAYS),
                  dedup=WHOLE_ROW),
        TableSpec("tendercontrolsafesettle", scalars=fields(SAFESETTLE_FIELDS), dedup=KEY,
                  required=_names(SAFESETTLE_FIELDS), dedup_first=True),
        TableSpec("tendercontroltillsettle", scalars=fields(TILLSETTLE_FIELDS),
                  arrays=fields(TILLSETTLE_ARRAYS), keep_empty=True,
                  required=("TransactionCount",), dedup=WHOLE_ROW),
        TableSpec("tendercontrolpaymentdeposit", scalars=fields(DEPOSIT_FIELDS),
                  arrays=fields(DEPOSIT_ARRAYS), marker="TenderControlTransaction__Version",
                  keep_empty=True, dedup=KEY),
        item_spec("Return"),
        item_spec("Sale"),
    )
}


def flatten(wide: DataFrame, spec: TableSpec, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Typed rows of a table before deduplication: project, unnest, cast, in that order,
    so that only the columns of this table are read."""
    df = wide.where(F.col(spec.marker).isNotNull()) if spec.marker else wide
    df = df.select(*[F.col(f.path).alias(f.name) for f in (*KEYS, *spec.leaves)], *extra)
    own = [f.name for f in (*KEYS, *spec.scalars)] + df.columns[len(KEYS) + len(spec.leaves):]
    if spec.arrays:
        arrays = [f.name for f in (*spec.arrays, *spec.nested)]
        df = zip_explode(df, arrays, own, outer=spec.keep_empty)
        own += [f.name for f in spec.arrays]
    if spec.nested:
        df = zip_explode(df, [f.name for f in spec.nested], own, outer=spec.keep_empty_nested)
    known = {f.name: f.type for f in (*KEYS, *spec.leaves)}
    return df.select(
        *[F.col(c).try_cast(known[c]).alias(c) if c in known else F.col(c) for c in df.columns]
    )


def finish(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Required columns, one row per key, business day.

    Lines move by their key before they are sorted by it: a part of a compressed source file
    unnests to more lines than fit in memory for a sort in front of the move, which would save
    no more than the nested entries of a line beyond the first."""
    if spec.required and not spec.dedup_first:
        df = require(df, spec.required)
    if spec.dedup == WHOLE_ROW:
        df = df.distinct()
    elif spec.dedup == LINE_KEY:
        df = dedup_by_key(df.repartition(*LINE_KEY), LINE_KEY)
    elif spec.dedup:
        df = dedup_by_key(df, list(spec.dedup))
    if spec.required and spec.dedup_first:
        df = require(df, spec.required)
    return df.withColumn("Date", business_day(RECEIPT_TIME))


def build(wide: DataFrame, name: str) -> DataFrame:
    """A table that needs nothing beyond its specification."""
    spec = SPECS[name]
    return finish(flatten(wide, spec), spec)


def _first_present(columns: dict[str, str], default: str | None = None) -> Column:
    return first_match([Rule(v, F.col(c).isNotNull()) for c, v in columns.items()], default)


def build_transactionheader(wide: DataFrame, mask_key: int | None = None) -> DataFrame:
    """Headers of all transaction types; transactions of no known type are dropped. The
    employee id is masked when a key is given."""
    kind = _first_present(TYPE_MARKERS).alias("TransactionType")
    df = flatten(wide, SPECS["transactionheader"], (kind,))
    df = require(df, [STORE, WORKSTATION, SEQUENCE, RECEIPT_TIME, "TransactionType"])
    df = df.withColumns(
        {"xmlfilename": file_base_name("xmlfilename"), "BusinessDay": business_day(RECEIPT_TIME)}
    )
    df = dedup_by_key(df, [*KEY, "TransactionType", "FunctionLogStoreInfoID"])
    return df if mask_key is None else df.withColumn("EmployeeID", xor_mask("EmployeeID", mask_key))


def build_controltransaction(wide: DataFrame) -> DataFrame:
    kind = _first_present(CONTROL_KINDS, OTHER_CONTROL)
    return build(wide, "controltransaction").withColumn("ControlTransactionType", kind)


def build_item(wide: DataFrame, side: str) -> DataFrame:
    """Sale or return positions; a unit count of zero means unknown."""
    return build(wide, side.lower()).withColumn("Units", zero_to_null("Units"))


def build_positionaddon(wide: DataFrame) -> DataFrame:
    sides = [finish(flatten(wide, position_addon_spec(s)), position_addon_spec(s)) for s in ("Return", "Sale")]
    return sides[0].unionByName(sides[1])


def build_pricemodifier(wide: DataFrame) -> DataFrame:
    """Price modifiers of both sides. They are keyed by receipt number; the published
    table has neither sequence number nor date."""
    both = None
    for side in ("Return", "Sale"):
        part = require(flatten(wide, modifier_spec(side)), ["PriceModifierSequenceNumber"])
        both = part if both is None else both.unionByName(part)
    key = [STORE, WORKSTATION, RECEIPT_TIME, RECEIPT_NUMBER, LINE_NUMBER, "PriceModifierSequenceNumber"]
    return dedup_by_key(both.drop(SEQUENCE), key)


def build_rebate(wide: DataFrame) -> DataFrame:
    both = None
    for side, mark in REBATE_FLAG.items():
        part = flatten(wide, rebate_spec(side)).withColumn("SaleReturnFlag", F.lit(mark))
        both = part if both is None else both.unionByName(part)
    key = [STORE, WORKSTATION, RECEIPT_TIME, RECEIPT_NUMBER, LINE_NUMBER,
           "RetailPriceModifierSequenceNumber"]
    return dedup_by_key(both, key)


def build_customer(wide: DataFrame, numeric_account: bool = True) -> DataFrame:
    """One customer per receipt, its address lines joined by commas."""
    spec = SPECS["customer"]
    if not numeric_account:
        as_text = tuple(
            Field(f.path, f.name, "string") if f.name == "AccountNumber" else f for f in spec.arrays
        )
        spec = TableSpec(spec.name, arrays=as_text, keep_empty=True, dedup=spec.dedup)
    address = F.concat_ws(",", F.col(CUSTOMER_ADDRESS)).alias("Address")
    return finish(flatten(wide, spec, (address,)), spec)


def build_retailheader(wide: DataFrame) -> DataFrame:
    """Retail headers with the three amounts picked out of the list of totals."""
    spec = SPECS["retailtransactionheader"]
    picked = named_totals(wide, TOTAL_NAMES, TOTAL_VALUES, TOTALS)
    amounts = tuple(F.col(c).try_cast("double").alias(c) for c in TOTALS)
    return finish(flatten(picked, spec, amounts), spec)


def build_paymentdeposit(wide: DataFrame, mask_key: int | None = None) -> DataFrame:
    df = build(wide, "tendercontrolpaymentdeposit")
    return df if mask_key is None else df.withColumn("EmployeeID", xor_mask("EmployeeID", mask_key))


BUILDERS = {
    "transactionheader": build_transactionheader,
    "controltransaction": build_controltransaction,
    "functionlog": lambda w: build(w, "functionlog"),
    "lineitem": lambda w: build(w, "lineitem"),
    "loyaltyreward": lambda w: build(w, "loyaltyreward"),
    "receiptheaderaddonlist": lambda w: build(w, "receiptheaderaddonlist"),
    "receiptpositionaddonlist": build_positionaddon,
    "customer": build_customer,
    "retailpricemodifier": build_pricemodifier,
    "return": lambda w: build_item(w, "Return"),
    "sale": lambda w: build_item(w, "Sale"),
    "retailtransactionheader": build_retailheader,
    "tender": lambda w: build(w, "tender"),
    "tendercontrolloan": lambda w: build(w, "tendercontrolloan"),
    "tendercontrolpickup": lambda w: build(w, "tendercontrolpickup"),
    "tendercontrolsafesettle": lambda w: build(w, "tendercontrolsafesettle"),
    "tendercontroltillsettle": lambda w: build(w, "tendercontroltillsettle"),
    "tendercontrolpaymentdeposit": build_paymentdeposit,
    "salereturn_rebate": build_rebate,
}
