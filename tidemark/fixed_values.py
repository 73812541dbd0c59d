"""Codes, names, dates and column names that results depend on."""

from datetime import date, datetime

# Source environments.
ENVIRONMENTS = ("NL", "UK", "BE", "FR", "US", "ES", "DE")

# Tables ingested each day, and those whose source folder has another name.
INGESTED_TABLES = (
    "ContractMutations ContractEvents ConversionStatus CreditManagementStatus Accounts ActivitySectors"
    " AppUsageFreeReasons AppUsageLines BlockingStatus BusinessTypes Classifications CompanySizes Contacts"
    " CustomerSubscriptionStatistics DivisionDivisionTypes ItemFeaturesets Featuresets DivisionStatistics"
    " DivisionTypes Documents ExchangeRates ExchangeRateTypes FirstAppUsage FirstAppUsagePerDivision"
    " GLTransactionSources ItemClasses ItemRelationRelations ItemRelations TimeCostTransactions Units"
    " UsageEntitlements UsageTransactions UserDivisionHistory Users UserTypes UserUserTypes"
    " ItemRelationTypes Items LeadSources MonthlyAppUsage OAuthClients OAuthClientUsers Opportunities"
    " OpportunityStages OpportunityStatus PaymentTerms Persons Projects SubscriptionQuotations"
    " SurveyResults ContractLines Contracts Divisions Requests OAuthClientContracts OAuthScopes"
    " OAuthClientScopes ActiveUserDivisions ActiveUserRoles DivisionTypeFeatureSets"
).split()
SOURCE_FOLDERS = {
    "ContractLines": "CIG_Contractlines",
    "Contracts": "CIG_Contracts",
    "Divisions": "CIG_Divisions",
    "Requests": "CIG_Requests",
}

# First copy time with complete payment terms and usage transactions.
COMPLETE_SINCE = datetime(2018, 10, 5)

# Conversion status codes.
CONVERSION_STATUS = {
    3: "csChecking",
    5: "csUploading",
    8: "csUploadFailed",
    10: "csUploaded",
    11: "csInsertOnHold",
    15: "csInserting",
    18: "csInsertFailed",
    20: "csInserted",
    21: "csConvertOnHold",
    25: "csConverting",
    28: "csConvertFailed",
    30: "csReady",
    35: "csWaitingToBeMoved",
    38: "csHandoverFailed",
    40: "csHandedOver",
}

# Answers to survey question 0.
SURVEY_ANSWERS = {
    0: "My accountant does not work with EOL",
    1: "Have not chosen accountant",
    2: "No need external accountant",
    3: "Disallow accountant direct access",
    4: "Other reasons",
    5: "Intend to link accountant but skip the step later (* This answer is not visible to the user)",
}

# Startup types of a division.
STARTUP_TYPES = {
    "E": "Empty",
    "X": "LegislationTemplate",
    "Y": "LegislationDemo",
    "A": "DivisionTemplate",
    "D": "DivisionCopy",
    "R": "DivisionReturn",
    "C": "Conversion",
    "U": "Unknown",
}

# Account classes that count for active modules.
MODULE_CLASSES = ("AC7", "AC1", "JB0", "EOL", "ACC")

# Counters that make an automatic bank link.
BANK_LINK_COUNTERS = ("banklinkscount", "rabobanklinks", "abnamrobanklinks", "ingbanklinks")

# Statistics columns that were added later.
LATER_COUNTERS = ("abnamrobanklinksbgwpsd2", "ingbanklinksbgwsftp", "knabbanklinksbgwsftp")

# Statistics columns that are floats.
STATISTICS_FLOATS = (
    "cashentryavglines bankentryavglines bankentryavglinesimport bankentryavglinesmanual"
    " salesentryavglines purchaseentryavglines generaljournalentryavglines salesorderentryavglines"
    " deliveryentryavglines stockentryreturnavglines purchaseorderentryavglines receiptentryavglines"
    " receiptreturnavglines stockcountentryavglines psnaveragesubscriptioninvoiceamount"
    " shoporderroutingstepsavglines shopordermaterialsavglines salesinvoiceavglines"
    " salespricelistperiodavgitemcount purchaseinvoiceavglines purchasepricelistperiodavgitemcount"
    " warehousetransferavglines locationtransferavglines smartmatchingwriteoffboundarysetting"
    " batchesperpaymentfileavgcount paymenttransactionsperbatchavgcount"
).split()

# Statistics columns that are whole numbers.
STATISTICS_COUNTERS = (
    "division conversionsource templatedivision taxreturnmethod gltransactionscount vattransactions"
    " fctransactions invoicelinescount banklinkscount bankaccountscount bankimportfilescount"
    " bankexportfilescount rabobankaccounts rabobanklinks rabobankimportfiles rabobankexportfiles"
    " abnamrobankaccounts abnamrobanklinks abnamrobankstatementfiles ingbankaccounts ingbanklinks"
    " ingbankstatementfiles ingbankpaymentfiles ingbankdirectdebitfiles leadcount opportunitycount"
    " quotecount employeecount accountcount customercount suppliercount glaccountcount assetcount"
    " allocationrulecount documentcount itemcount journalcount cashjournalcount bankjournalcount"
    " salesjournalcount purchasejournalcount generaljournalcount cashentrycount cashentrymaxlines"
    " cashtransactions bankentrycount bankentrymaxlines banktransactions bankentrycountimport"
    " bankentrymaxlinesimport banktransactionsimport bankentrycountmanual bankentrymaxlinesmanual"
    " banktransactionsmanual salesentrycount salesentrymaxlines salestransactions purchaseentrycount"
    " purchaseentrymaxlines purchasetransactions generaljournalentrycount generaljournalentrymaxlines"
    " generaljournaltransactions costcentertransactions costunittransactions depreciationplancount"
    " opportunitystagecount leadsourcecount salestypecount reasoncodecount budgetcount"
    " paymenttermcount sourcenormal sourcebankimport sourcexmlimport sourceconversion sourceinvoice"
    " sourcerevaluation sourcefixedentry sourcevatreturn sourceglmatching sourceexchangeratediff"
    " fixedsalesentrycount fixedpurchaseentrycount fixedgeneraljournalentrycount"
    " fixedsalesinvoicecount xbrldocumentsbd xbrldocumentskvk projectapproveentries projectuseproposal"
    " projectmandatoryproject projectconsolidatenone projectconsolidateitem"
    " projectconsolidateitemproject projectconsolidateitememployee"
    " projectconsolidateitememployeeproject projecttypefixedprice projecttypetimeandmaterial"
    " projecttypenonbillable projecttotalemployees projecttotaltimeentries projecttotalcostentries"
    " projecttotalabsenceentries projecttotalleaveentries projecttotaltimecorrectionentries"
    " projecttotalsingleplanning projecttotalrecurringplanning projecttotalnationalholiday"
    " projectinvoiceasquoted projecttypeprepaidretainer projecttypeprepaidhtb projectwithwbs"
    " costpricetransactioncount salesorderentrycount salesorderentrymaxlines deliveryentrycount"
    " deliveryentrymaxlines deliverytransactions stockentryreturncount stockentryreturnmaxlines"
    " stockentryreturntransactions purchaseorderentrycount purchaseorderentrymaxlines"
    " receiptentrycount receiptentrymaxlines receipttransactions receiptreturncount"
    " receiptreturnmaxlines receiptreturntransactions stockcountentrycount stockcountentrymaxlines"
    " stockcounttransactions psnsubscriptontypeautomaticallyrenewedcount"
    " psnsubscriptontypemanuallyrenewedcount psnsubscriptontypenotrenewedcount"
    " psnsubscriptionautomaticallyrenewedcount psnsubscriptionmanuallyrenewedcount"
    " psnsubscriptionnotrenewedcount psnsubscriptionyearlycount psnsubscriptionhalfyearlycount"
    " psnsubscriptionquarterlycount psnsubscriptionmonthlycount psnsubscriptionprintedcount"
    " psnsubscriptioninvoicecount payrollactiveemployees payrollclacount payrolldepartmentcount"
    " payrolljobtitlecount payrolldivisiontype payrollfrequencyyearlyexists"
    " payrollfrequencyquarterlyexists payrollfrequencymonthlyexists payrollfrequency4weeklyexists"
    " payrollfrequencyweeklyexists sourceelectronicinvoice electronicsalesentrycount"
    " electronicpurchaseentrycount quotationquantitiescount quotationmaterialscount"
    " quotationroutingstepscount shoporderscount shopordermaterialscount shoporderroutingstepscount"
    " shopordermaterialrealizationscount shoporderroutingsteprealizationscount"
    " shopordermaterialissuescount shopordersubcontractissuescount"
    " shoporderroutingsteptimeentriescount shoporderstockreceiptscount shoporderroutingstepsmaxlines"
    " shopordermaterialsmaxlines shopordersuborderlevelmax budgetscenariocount costcentercount"
    " costunitcount currencycount exchangeratecount sepabankaccountcount pageviewslastweek"
    " pageviewslastmonth backupcount restorecount backupsinuse backupminbatch backupmaxbatch"
    " inconsistentar inconsistentap inconsistentptmatching inconsistentglmatching"
    " inconsistentbalanceentry inconsistentbalanceperiod inconsistentbalancedate"
    " inconsistentreportingbalance inconsistentbatchitems inconsistentserialitems"
    " inconsistentsalesorderstatus inconsistentpurchaseorderstatus sizekb attachmentsizekb"
    " fulltextwordssizekb backupsizekb applicationlogsizekb gltransactionssizekb intrastatsales"
    " intrastatpurchase mailboxprocessedemailcount mailboxprocessedemailsize"
    " mailboxprocessedattachmentsize requestcount campaigncount marketinglistcount"
    " campaignlinkedtomailchimpcount marketinglistlinkedtomailchimpcount accountlinkedtolinkedincount"
    " contactlinkedtolinkedincount accountlinkedtotwittercount contactlinkedtotwittercount"
    " accountlinkedtoadministrationcount accountlinkedtomultipleadministrationscount indicatorscount"
    " starterusersaccesstocompanycount documentfolderscount documentswithfoldercount"
    " purchasesendercount salessendercount crmsendercount salesinvoicecount salesinvoicemaxlines"
    " dropshipsalesordercount dropshipsuppliersalesordercount salespricelistcount"
    " salespricelistperiodcount salespricelistperiodmaxitemcount purchaseinvoicecount"
    " purchaseinvoicemaxlines purchasepricelistcount purchasepricelistperiodcount"
    " purchasepricelistperiodmaxitemcount batchitemcount serialitemcount assemblyordercount"
    " warehousetransfercount warehousetransfermaxlines locationtransfercount locationtransfermaxlines"
    " useallownegativestock usesalesorderapproval usetranssmart usemandatoryserialnumber"
    " usereceivemorethanordered userswithchangedcompanyrightscount customerswithinvolveduserscount"
    " userssetasinvolvedcount itemlowestlevelmax employeeswithemployeeratecount hrmapproveleave"
    " hrmapproveleavebuildup projectblockhistoricalentry projectdefaultalertwhenexceeding"
    " projectinvoiceproposalreasons projectnotesmandatory projectrequiresprojectwbs projectsendemails"
    " automatedbankimportsetting glaccountclassificationlinksrgs1 glaccountclassificationlinksrgs3"
    " glaccountsuggestionsdirectentrysetting projecttotalleavebuildupentries ctibingbankcount"
    " ctibothersbankcount ctibmatchescount ctibdisabledcount batchesperpaymentfilemaxcount"
    " purchaseentrycountforlast90days electronicpurchaseentrycountforlast90days"
    " clientactivitymonthlyexists inactiveaccountcount anonymizedaccountcount contactcount"
    " anonymizedcontactcount inactiveemployeecount anonymizedemployeecount usercount inactiveusercount"
    " anonymizedusercount scanningserviceautomaticbooking purchaseentryapprovalenabled"
    " purchaseentryapproverscount invoiceproposals projectsalesinvoices"
    " mail2eolpurchaseemailallowedsenderscount mail2eolsalesallowedsenderscount"
    " mail2eoldocumentsallowedsenderscount abnamrobanklinksbgwpsd2 knabbanklinksbgwsftp"
    " ingbanklinksbgwsftp knabbankaccounts knabbanktransactionfeeds"
).split()

# Statistics columns that are moments.
STATISTICS_MOMENTS = (
    "openingbalancefirstdate lastlogin salesorderlastcreationdate purchaseorderlastcreationdate"
    " shoporderlastcreationdate lastbackup lastrestore salesinvoicefirstdate consultancydate"
    " scanningservicelastusage lastcollected lastcopied sysmodified syscreated cigcopytime"
    " lastcollectedinconsistencies mail2eolpurchaseemaillastusage mail2eolsalesemaillastusage"
    " mail2eoldocumentsemaillastusage"
).split()

# Whole-number statistics that the summary has and the daily table doesn't type.
STATISTICS_ADDED = (
    "abnamrobanklinksbgwpsd2 knabbanklinksbgwsftp ingbanklinksbgwsftp knabbankaccounts"
    " knabbanktransactionfeeds"
).split()

# Statistics columns without a place in the daily table.
DAILY_DROPPED = (
    "bankaccountscount bankexportfilescount bankimportfilescount banklinkscount cigcopytime"
    " cigprocessed consultancydate conversionsource costtyperestrictions"
    " documentmissingofficialreturncount employeerestrictions freedatefield_01 freedatefield_02"
    " freedatefield_03 freedatefield_04 freedatefield_05 freedatefield_06 freedatefield_07"
    " freedatefield_08 freedatefield_09 freedatefield_10 freeintfield_01 freeintfield_02"
    " freeintfield_03 freeintfield_04 freeintfield_05 freeintfield_06 freeintfield_07"
    " freeintfield_08 freeintfield_09 freeintfield_10 freeintfield_11 freeintfield_12"
    " freeintfield_13 freeintfield_14 freeintfield_15 freeintfield_16 freeintfield_17"
    " freeintfield_18 freeintfield_19 freeintfield_20 freetextfield_01 freetextfield_02"
    " freetextfield_03 freetextfield_04 freetextfield_05 hourtypecount hourtyperestrictions"
    " ingestionday ingestionmonth ingestionyear itemlistextrafieldscount itemtextextrafieldscount"
    " lastbackup lastcollected lastcollectedinconsistencies lastcopied lastlogin lastrestore"
    " officialreturnwithduplicatedetailscount openingbalancefirstdate perioddatecheck"
    " projectconsolidateitememployeeprojectwbs projectconsolidateitemprojectwbs"
    " projecthourtypebudget projectplanningcommunicationews projectplanningcommunicationoffice365"
    " psnsubscriptionmidtermchangecount psnsubscriptiononetimefees purchaseentryapprovalenabled"
    " purchaseentryapproverscount purchaseorderlastcreationdate rebillingrestrictions"
    " salesinvoicefirstdate salesorderlastcreationdate scanningserviceautomaticbooking"
    " scanningservicelastusage shoporderlastcreationdate ssfusercount startuptype syscreated"
    " syscreator sysmodified sysmodifier taxfrequency taxreturnmethod taxsystem templatecode"
    " templatedivision workcentercount"
).split()

# Counters compared from day to day.
CHANGE_COUNTERS = (
    "gltransactionscount vattransactions invoicelinescount sourcevatreturn opportunitycount"
    " accountcount customercount suppliercount glaccountcount documentcount itemcount"
    " cashentrycount cashtransactions automaticbanklink rabobankaccounts abnamrobankaccounts"
    " ingbankaccounts bankentrycount banktransactions banktransactionsimport"
    " banktransactionsmanual salesentrycount salestransactions purchaseentrycount"
    " purchasetransactions generaljournalentrycount generaljournaltransactions"
    " projecttotalemployees projecttotaltimeentries projecttotalcostentries"
    " projecttypefixedprice projecttypetimeandmaterial projecttypenonbillable"
    " projecttypeprepaidretainer projecttypeprepaidhtb salesorderentrycount"
    " stockcountentrycount stockcounttransactions salesinvoicecount purchaseinvoicecount"
    " starterusersaccesstocompanycount userswithchangedcompanyrightscount"
    " userssetasinvolvedcount customerswithinvolveduserscount leadsourcecount"
    " electronicpurchaseentrycount electronicsalesentrycount"
).split()

# History of divisions starts on this day, one day earlier in the US.
HISTORY_START = date(2016, 11, 15)
HISTORY_START_US = date(2016, 11, 14)
NO_NEIGHBOUR_CODE = 999
NO_NEIGHBOUR_TIME = datetime(1900, 1, 1)
EARLIEST_REAL_TIME = datetime(1990, 1, 1)

# Key events taken from a positive daily counter.
COUNTER_EVENTS = {
    "First Account Card": ("accountcount",),
    "First Bank Account": ("ingbankaccounts", "rabobankaccounts", "abnamrobankaccounts"),
    "First Bank Entry Manual": ("bankentrycountmanual",),
    "First Bank Link": ("automaticbanklink",),
    "First Bank Statement Import": ("banktransactionsimport",),
    "First Opportunity": ("opportunitycount",),
    "First Project": (
        "projecttypefixedprice",
        "projecttypetimeandmaterial",
        "projecttypenonbillable",
        "projecttypeprepaidhtb",
        "projecttypeprepaidretainer",
    ),
    "First Project Sales Invoice": ("projectsalesinvoices",),
    "First Purchase Entry": ("purchaseentrycount",),
    "First Time Entry": ("projecttotaltimeentries",),
}
# Events whose counters are added up instead of tested one by one.
SUMMED_EVENTS = ("First Project",)

# The other key events.
FIRST_CONSULT = "First Consult"
FIRST_CONSULT_REQUESTED = "First Consult Requested"
FIRST_MOBILE_USE = "First Time Mobile App Used"
FIRST_SALES_INVOICE = "First Sales Invoice"
FIRST_ACCOUNTANT_LINKED = "First Time Accountant Linked"
LEGISLATION_TEMPLATE = "Legislation Template Created"
CONSULT_ITEM_PATTERN = "%EOLCONSULT%"
CONSULT_REQUEST_EXCLUDED_STATUS = "S"
MOBILE_ACTIVITY = "8"
LINKED_STATUS = "Accountant Linked"
LEGISLATION_STARTUP_TYPE = "X"

# Activities and dates of the master-data setup.
SETUP_SINCE = datetime(2017, 1, 1)
ACCESS_ACTIVITY = "1"
IMPORT_ACTIVITIES = ("5304", "5335", "5304202", "5334202")
IMPORT_SUCCESS_ACTIVITIES = ("5304202", "5334202")
SAVE_ACTIVITY = "511006"
SAVES_STARTED = 5
BLOCKED_FROM = 100
REJECTED_REQUEST_STATUS = 5

# Setup types.
ACCOUNTANT_TEMPLATE = "AccountantTemplate"
CONVERSION = "Conversion"
COPY = "DivisionCopy"
DEMO = "Demo"
EMPTY = "Empty"
IMPORT = "XML/CSV_Import"
TEMPLATE = "ExactTemplate"
TEMPORARY = "TemporaryDivision"
TRANSFER = "DivisionTransfer"

# Columns masked for erased accounts, and the mask.
MASKED_COLUMNS = ("description", "chamberofcommerce", "city", "postcode", "dunsnumber", "website")
MASK = "####"

# Fixed value: the column of a CRM account that holds the account it refers to.
CRM_ACCOUNT_COLUMN = "exact_id__c"

# Request columns that hold identifiers.
REQUEST_UPPER = (
    "id account contact syscreator sysmodifier approver type userid realizer environment document"
).split()
