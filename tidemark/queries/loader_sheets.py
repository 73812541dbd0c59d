"""What each loaded table has to look like, stated apart from the loaders.

The raw tables and SQL statements of the loader queries are made from these sheets alone, and the loaders
from their own descriptions, so a wrong cast, name or key in either shows. A sheet names columns as
``name:kind>new`` (kinds: t moment, d date, i whole number, l long, b boolean, f double; none: text) and, after
``drop``, the columns that leave.
"""

from __future__ import annotations

from tidemark.plans.loaders import Loader

_KINDS = {"t": "timestamp", "d": "date", "i": "integer", "l": "long", "b": "boolean", "f": "double"}


def sheet(columns: str, drop: str = "", **options) -> Loader:
    types: dict[str, list[str]] = {}
    rename = {}
    for entry in columns.split():
        column, _, new = entry.partition(">")
        name, _, kind = column.partition(":")
        if kind:
            types.setdefault(_KINDS[kind], []).append(name)
        if new:
            rename[name] = new
    for name in ("keys", "order", "upper", "trim", "select"):
        if name in options:
            options[name] = tuple(options[name].split(",")) if "," in options[name] or name == "order" else tuple(options[name].split())
    return Loader(types=types, rename=rename, drop=tuple(drop.split()), **options)


_ID, _FULL = {"upper": "id"}, "timestamp_ntz '2018-10-05 00:00:00'"

# The columns of each table.
SHEETS: dict[str, Loader] = {
    "contracts": sheet(
        "cigprocessed:b cigcopytime:t syscreated:t sysmodified:t startdate:t enddate:t finaldate:t cancellationdate:t",
        "cigcopytime cigprocessed",
    ),
    "accounts": sheet(
        "isbank:b ispilot:b issupplier:b issales:b ispurchase:b isreseller:b ismember:b blocked:b"
        " purchaseorderconfirmation:b reminder:b backorders:b attention:b candropship:b cigprocessed:b"
        " processedbybackgroundjob:b recepientofcommissions:b division:i isaccountant:i iscompetitor:i invoicecopies:i"
        " isagency:i usetimespecification:i ismailing:i costpaid:i separateinvperproject:i separateinvpersubscription:i"
        " consolidationscenario:i securitylevel:i quotationmarkuptype:i shippingleaddays:i purchaseleaddays:i"
        " maindivision:i customerdivision:i rating:i isanonymized:i anonymisationsource:i cigcopytime:t syscreated:t"
        " sysmodified:t controlleddate:t checkdate:t startdate:t enddate:t customersince:t statussince:t"
        " webaccesssince:t datemodifiedbycoc:d establisheddate:d creditlinesales:f creditlinepurchase:f discountsales:f"
        " discountpurchase:f profitpercentage:f labormarkuppercentage:f purchasemarkuppercentage:f"
        " purchasemarkuppercentageproject:f longitude:f latitude:f",
        "county geolocation", keys="division id", **_ID,
    ),
    "paymentterms": sheet(
        "id>paymenttermsid account>accountid division:i>divisioncode transactionreversal:b linetype:i endyear:i"
        " endperiod:i entrynumber:i invoicenumber:i status:i source:i paymentdays:i transactiontype:i"
        " transactionreportingyear:i transactionreportingperiod:i transactionstatus:i entrydate:t invoicedate:t"
        " duedate:t enddate:t transactionduedate:t syscreated:t sysmodified:t cigcopytime:t amountfc:f ratefc:f"
        " amountdc:f paymentdiscount:f transactionamountfc:f transactionamountdc:f",
        "cigprocessed", after=f"cigcopytime >= {_FULL}", **_ID,
    ),
    "persons_email": sheet("id>personid cigcopytime:t", select="personid email", **_ID),
    "users_googleclientid": sheet("id>userid cigcopytime:t", select="userid googleclientid", **_ID),
    "oauthclients": sheet(
        "id>applicationid", clean="none",
        select="applicationid account descriptiontermid description applicationname logo type startdate enddate"
        " returnurl syscreated syscreator sysmodified sysmodifier logofilename privilegedaccess publishdate"
        " allowresourceownerflow category cigcopytime environment cigprocessed",
    ),
    "users": sheet(
        "id>userid customer>accountid person>personid hid:i authenticationtype:i lockoutattempts:i blocked:b"
        " cigcopytime:t syscreated:t sysmodified:t lockouttime:t startdate:t enddate:t validationdate:t lastlogin:t"
        " totpregistrationutcdate:t totpskippedutc:t totpforcedbyexactutc:t marketingoptindate:t marketingoptoutdate:t",
        "googleclientid username cigprocessed",
    ),
    "persons": sheet(
        "id>personid customer>accountid hid:i namecomposition:i anonymisationsource:i isanonymized:b cigcopytime:t"
        " syscreated:t sysmodified:t",
        "hid googleclientid username cigprocessed longitude latitude addressline3 email",
    ),
    "activitysectors": sheet("descriptiontermid:i syscreated:t sysmodified:t cigcopytime:t cigprocessed:b"),
    "companysizes": sheet(
        "descriptiontermid:i employeecountfrom:i employeecountto:i syscreated:t sysmodified:t cigcopytime:t cigprocessed:b"
    ),
    "contacts": sheet(
        "id>contactid person>personid division:i>divisioncode account>accountid businesstypeid>businesstype"
        " companysizeid>companysize sectorid>activitysector subsectorid>activitysubsector syscreated:t sysmodified:t"
        " startdate:t enddate:t cigcopytime:t ismailingexcluded:b isuxparticipant:b",
        "cigprocessed",
    ),
    "divisions": sheet(
        "main:b customerportal:b cigcopytime:t syscreated:t sysmodified:t deleted:t enddate:t startdate:t sharecapital:f"
        " code:i>divisioncode blockingstatus:i>blockingstatuscode status:i linkeddivision:i origin:i legislationcode:l"
        " description>divisiondescription customer>accountid businesstype>businesstypeid companysize>companysizeid"
        " activitysector>sectorid activitysubsector>subsectorid",
        "account cigprocessed hid sector subsector taxofficenumber",
        clean="upper", upper="environment", keys="environment code",
    ),
    "divisiondivisiontypes": sheet(
        "cigcopytime:t syscreated:t sysmodified:t divisioncode:i cigprocessed:b enddate:d startdate:d invoiceduntil:d",
        keys="environment divisioncode divisiontype", order="cigcopytime desc,syscreated desc",
    ),
    "creditmanagementstatus": sheet(
        "cigcopytime:t syscreated:t sysmodified:t division:i descriptiontermid:i isactive:i cigprocessed:b"
    ),
    "customersubscriptionstatistics": sheet(
        "id>customersubscriptionstatisticid account>accountid reseller>resellerid accountant>accountantid cigcopytime:t"
        " syscreated:t type:i source:i cigprocessed:b usesimplewizard:b"
    ),
    "divisiontypes": sheet(
        "descriptiontermid:i modules:l", "cigcopytime cigprocessed syscreated sysmodified syscreator sysmodifier",
        keys="environment code",
    ),
    "itemclasses": sheet("cigcopytime:t division:i classid:i descriptiontermid:i cigprocessed:b"),
    "itemrelations": sheet("cigcopytime:t type:i division:i cigprocessed:b quantity:f maxquantity:f"),
    "leadsources": sheet("cigcopytime:t sysmodified:t syscreated:t division:i descriptiontermid:i cigprocessed:b active:b"),
    "opportunities_hosting": sheet(
        "cigcopytime:t closedate:t actiondate:t syscreated:t sysmodified:t division:i number:i opportunitytype:i"
        " opportunitydepartment:i cigprocessed:b ownerread:b probability:f amountfc:f amountdc:f ratefc:f",
        "reseller accountant involvementtype",
    ),
    "opportunitystages": sheet(
        "cigcopytime:t syscreated:t sysmodified:t color:i descriptiontermid:i forecasttype:i opportunitystatus:i"
        " sortorder:i division:i cigprocessed:b active:b probability:f"
    ),
    "items": sheet(
        "id>itemid code>itemcode description>itemdescription class_02>itemtype modulecode:l topictime:l syscreated:t"
        " sysmodified:t cigcopytime:t startdate:t enddate:t"
        + "".join(f" freedatefield_0{n}:t freeboolfield_0{n}:b" for n in range(1, 6))
        + "".join(f" freenumberfield_0{n}:f" for n in range(1, 9))
        + " isbatchnumberitem:b ismakeitem:b isnewcontract:b istime:b istaxable:b isondemanditem:b iswebshopitem:b"
        " isregistrationcodeitem:b roundeach:b roundplannedquantityfactor:b useexplosion:b copyremarks:b issalesitem:b"
        " isstockitem:b isserialnumberitem:b issubassemblyitem:b isfractionalloweditem:b isassetitem:b ispurchaseitem:b"
        " issubcontracteditem:b ispackageitem:b cigprocessed:b hasbillofmaterial:b costpricestandard:f batchquantity:f"
        " grossweight:f averagecost:f netweight:f length:f width:f depth:f margin:f weightfactor:f costpricenew:f"
        " calculatorunitfactor:f statisticalunits:f statisticalquantity:f statisticalvalue:f statisticalnetweight:f"
        " division:i securitylevel:i assembledleaddays:i calculatortype:i calculatorunitfactortype:i"
        " descriptiontermid:i extradescriptiontermid:i"
    ),
    "appusagelines": sheet(
        "syscreated:t sysmodified:t usedondate:t cigcopytime:t cigprocessed:b useddivision:i",
        clean="upper", upper="id userid oauthclient syscreator sysmodifier environment",
    ),
    "blockingstatus": sheet(
        "id>blockingstatuscode description>blockingstatusdescription cigcopytime:t descriptionsuffixtermid:i descriptiontermid:i",
        "cigprocessed environment", clean="none", trim="id", before="upper(trim(environment)) = 'NL'",
        final_types={"integer": ("blockingstatuscode",)},
    ),
    "businesstypes": sheet(
        "syscreated:t sysmodified:t cigcopytime:t descriptiontermid:i shortdescriptiontermid:i cigprocessed:b",
        clean="upper", upper="environment", before="environment = 'NL'",
    ),
    "contractmutations": sheet(
        "syscreated:t sysmodified:t eventdate:t cigcopytime:t division:i quantity:i hid:l cigprocessed:b contractlinevalue:f",
        clean="upper", upper="environment",
    ),
    "contractevents": sheet(
        "syscreated:t sysmodified:t cigcopytime:t descriptiontermid:i creationtype:i cigprocessed:b",
        clean="upper", upper="environment",
    ),
    "accountsclassifications": sheet(
        "code>accountclassificationcode description>accountclassificationdescription syscreated:t sysmodified:t"
        " cigcopytime:t cigprocessed:b division:i descriptiontermid:i",
        clean="upper", upper="id creditmanagementscenario syscreator sysmodifier environment",
    ),
    "contractlines": sheet(
        "syscreated:t sysmodified:t cigcopytime:t startdate:t finaldate:t cancellationdate:t cigprocessed:b price:f quantity:f",
        "cancellationeventid contracteventid discount enddate item itemnumber itemprice linedescription prolongdaypart"
        " unitfactor usagequantity",
        clean="upper", upper="id contractid syscreator sysmodifier environment",
    ),
    "saleshandoverdocument": sheet(
        "id>documentid account>accountid contact>contactid item>itemid owner>ownerid type:i hid:i ownertype:i status:i"
        " source:i cigcopytime:t sysmodified:t startdate:t enddate:t syscreated:t",
        "parent category viewdate type division newstype entryid ownertypevalue votecount votesum itemnumber fpintrotext"
        " paymentreference yourref quotationnumber contractnumber currency documentdate layout templatetype ddview"
        " project itemgroup share employee opportunity lead emailimportance emailsent subscription stockentrynumber"
        " pages ordernumber campaign sourcemailmessageid asset shopordernumber documentfolder extension"
        " itemroutingstep itemmaterial cigcopytime environment cigprocessed",
        order="cigcopytime desc,sysmodified desc", before="type = 193", **_ID,
    ),
    "subscriptionquotations": sheet(
        "id>subscriptionquotationid customer>accountid item>itemid mainline:i discountperiod:i status:i discounttype:i"
        " firstyearnocancellation:i quantity:f discountamount:f totalmrr:f extraservicenumberofdays:f"
        " extraservicetotaldiscountamount:f extraservicegrossamount:f cigcopytime:t syscreated:t sysmodified:t",
        "cigprocessed", **_ID,
    ),
    "surveyresults": sheet(
        "id>surveyresultid customer>accountid fordivision:i>divisioncode cigprocessed:b questioncode:i objectiveanswer:i"
        " createddate:t cigcopytime:t", **_ID,
    ),
    "units": sheet("active:b cigprocessed:b division:i main:i descriptiontermid:i cigcopytime:t", **_ID),
    "usagetransactions": sheet(
        "cigprocessed:b division:i quantity:i sourcedivision:i amount:f costprice:f salesprice:f cigcopytime:t startdate:t"
        " enddate:t sysmodified:t syscreated:t", after=f"cigcopytime >= {_FULL}", **_ID,
    ),
    "usertypes": sheet(
        "id>usertypeid code>usertypecode description>usertypedescription descriptiontermid:i>usertypedescriptiontermid"
        " startpage:i gettingstartedpage:i cigcopytime:t syscreated:t sysmodified:t",
        "cigprocessed", keys="id item", order="cigcopytime desc,environment desc", upper="id item environment",
    ),
    "userusertypes": sheet(
        "usertype>usertypeid invoiceduntil:d cigcopytime:t startdate:t enddate:t syscreated:t sysmodified:t",
        "id cigprocessed", keys="userid", order="cigcopytime desc,syscreated desc", upper="userid",
    ),
    "projects": sheet(
        "id>projectid code>projectcode account>accountid accountcontact>accountcontactid manager>managerid"
        " classification>classificationid cigcopytime:t startdate:t enddate:t syscreated:t sysmodified:t"
        " salestimequantity:f salesamountdc:f timequantitytoalert:f costsamountfc:f purchasemarkuppercentage:f"
        " budgetsalesamountdc:f budgetcostsamountdc:f descriptiontermid:i type:i prepaidtype:i usebillingmilestones:i"
        " allowadditionalinvoicing:i blockentry:i blockrebilling:i budgettype:i invoiceasquoted:i financialyear:i",
        "division cigprocessed", **_ID,
    ),
    "timecosttransactions": sheet(
        "id>timecosttransactionid project>projectid account>accountid employee>employeeid item>itemid cigcopytime:t date:t"
        " starttime:t endtime:t syscreated:t sysmodified:t type:i hourstatus:i entrynumber:i source:i"
        " manufacturingtimetype:i setupcomplete:i backflushed:i isoperationfinished:i quantity:f pricefc:f amountfc:f"
        " laborhours:f producedquantity:f percentcomplete:f laborrate:f laborburdenrate:f machineburdenrate:f"
        " generalburdenrate:f amountdc:f ratefc:f purchaseamountfc:f purchasemarkuppercentage:f internalratedc:f costamountdc:f",
        "division cigprocessed", **_ID,
    ),
    "usageentitlements": sheet(
        "id>usageentitlementid account>accountid item>itemid cigcopytime:t startdate:t enddate:t expirationdate:t"
        " syscreated:t sysmodified:t unitprice:f originalquantity:i actualquantity:i",
        "division cigprocessed", **_ID,
    ),
    "active_user_divisions": sheet(
        "cigcopytime:t division:i", "cigprocessed", keys="environment id", upper="environment id userid"
    ),
    "active_user_roles": sheet(
        "cigcopytime:t role:i rolelevel:i", "cigprocessed", keys="environment id", upper="environment id userid userroleid"
    ),
    "divisiontypefeaturesets": sheet(
        "syscreated:t sysmodified:t cigcopytime:t featureset:i cigprocessed:b",
        keys="environment id", order="cigcopytime desc,syscreated desc", upper="id environment sysmodifier syscreator",
    ),
}
