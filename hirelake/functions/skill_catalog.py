"""Skill phrases of the postings profile.

Entries are (skill, category, aliases); the order of entries and of aliases
decides which one names a candidate and which one gives the evidence.
"""

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
SKILL_CATALOG = [
    # data and AI
    ("Natural Language Processing", "technical_skill", ["natural language processing", "nlp"]),
    ("Machine Learning", "technical_skill", ["machine learning"]),
    ("Deep Learning", "technical_skill", ["deep learning"]),
    ("Artificial Intelligence", "technical_skill", ["artificial intelligence", "ai"]),
    ("Data Engineering", "technical_skill", ["data engineering"]),
    ("Data Analysis", "technical_skill", ["data analysis", "data analytics"]),
    ("Data Visualization", "technical_skill", ["data visualization", "data visualisation"]),
    ("Business Intelligence", "technical_skill", ["business intelligence"]),
    ("Database Management", "technical_skill", ["database management"]),
    ("ETL", "technical_skill", ["etl", "extract transform load"]),
    # data tools
    ("Power BI", "technical_skill", ["power bi"]),
    ("Excel", "technical_skill", ["excel", "microsoft excel", "ms excel"]),
    ("Tableau", "technical_skill", ["tableau"]),
    ("Snowflake", "technical_skill", ["snowflake"]),
    ("Airflow", "technical_skill", ["airflow", "apache airflow"]),
    ("Apache Spark", "technical_skill", ["apache spark", "pyspark", "spark"]),
    ("dbt", "technical_skill", ["dbt"]),
    # programming
    ("Python", "technical_skill", ["python"]),
    ("SQL", "technical_skill", ["sql"]),
    ("Java", "technical_skill", ["java"]),
    ("JavaScript", "technical_skill", ["javascript"]),
    ("C++", "technical_skill", ["c++"]),
    ("C#", "technical_skill", ["c#", "c sharp"]),
    ("Git", "technical_skill", ["git"]),
    ("Linux", "technical_skill", ["linux"]),
    # cloud and software
    ("Docker", "technical_skill", ["docker"]),
    ("Kubernetes", "technical_skill", ["kubernetes"]),
    ("AWS", "technical_skill", ["aws", "amazon web services"]),
    ("Microsoft Azure", "technical_skill", ["azure", "microsoft azure"]),
    ("Google Cloud", "technical_skill", ["google cloud", "google cloud platform", "gcp"]),
    ("Cybersecurity", "technical_skill", ["cybersecurity", "cyber security"]),
    ("Network Administration", "technical_skill", ["network administration"]),
    ("Software Development", "technical_skill", ["software development"]),
    ("Web Development", "technical_skill", ["web development"]),
    ("API Development", "technical_skill", ["api development", "rest api", "restful api"]),
    # engineering and construction
    ("MEP BIM Coordination", "technical_skill", ["mep bim coordination"]),
    ("BIM", "technical_skill", ["bim", "building information modeling"]),
    ("AutoCAD", "technical_skill", ["autocad"]),
    ("Revit", "technical_skill", ["revit"]),
    ("CAD", "technical_skill", ["cad", "computer aided design"]),
    ("Quantity Surveying", "domain_skill", ["quantity surveying"]),
    ("Construction Management", "domain_skill", ["construction management"]),
    ("Civil Engineering", "domain_skill", ["civil engineering"]),
    ("Mechanical Engineering", "domain_skill", ["mechanical engineering"]),
    ("Electrical Engineering", "domain_skill", ["electrical engineering"]),
    ("Preventive Maintenance", "domain_skill", ["preventive maintenance", "preventative maintenance"]),
    ("Troubleshooting", "technical_skill", ["troubleshooting"]),
    ("Occupational Health and Safety", "domain_skill", ["occupational health and safety", "hse"]),
    # business and operations
    ("Project Management", "domain_skill", ["project management"]),
    ("Operations Management", "domain_skill", ["operations management"]),
    ("Supply Chain Management", "domain_skill", ["supply chain management"]),
    ("Inventory Management", "domain_skill", ["inventory management"]),
    ("Vendor Management", "domain_skill", ["vendor management", "vendor relationship", "vendor relationships"]),
    ("Supplier Management", "domain_skill", ["supplier management", "supplier relationship", "supplier relationships"]),
    ("Contract Management", "domain_skill", ["contract management"]),
    ("Procurement", "domain_skill", ["procurement", "purchasing operations"]),
    ("Financial Analysis", "domain_skill", ["financial analysis"]),
    ("Financial Reporting", "domain_skill", ["financial reporting"]),
    ("Accounting", "domain_skill", ["accounting"]),
    ("Auditing", "domain_skill", ["auditing", "audit management"]),
    ("Budgeting", "domain_skill", ["budgeting", "budget management"]),
    ("Risk Management", "domain_skill", ["risk management"]),
    ("Quality Assurance", "domain_skill", ["quality assurance", "quality control"]),
    ("Business Development", "domain_skill", ["business development"]),
    ("Customer Relationship Management", "domain_skill", ["customer relationship management", "crm"]),
    ("Customer Service", "soft_skill", ["customer service"]),
    ("Digital Marketing", "domain_skill", ["digital marketing"]),
    ("Marketing", "domain_skill", ["marketing"]),
    ("Sales", "domain_skill", ["sales"]),
    ("Recruitment", "domain_skill", ["recruitment", "talent acquisition"]),
    ("Human Resources", "domain_skill", ["human resources", "hr management"]),
    # healthcare
    ("Clinical Research", "domain_skill", ["clinical research"]),
    ("Medical Coding", "domain_skill", ["medical coding"]),
    ("Patient Care", "domain_skill", ["patient care"]),
    ("First Aid", "domain_skill", ["first aid"]),
    ("Food Safety", "domain_skill", ["food safety"]),
    ("Food Preparation", "domain_skill", ["food preparation"]),
    ("Nursing", "domain_skill", ["nursing"]),
    ("Pharmacy", "domain_skill", ["pharmacy"]),
    ("Nutrition", "domain_skill", ["nutrition"]),
    ("Counseling", "domain_skill", ["counseling", "counselling"]),
    # education and hospitality
    ("Lesson Planning", "domain_skill", ["lesson planning", "lesson plans"]),
    ("Classroom Management", "domain_skill", ["classroom management"]),
    ("Curriculum Development", "domain_skill", ["curriculum development"]),
    ("Event Management", "domain_skill", ["event management"]),
    ("Housekeeping", "domain_skill", ["housekeeping"]),
    ("Cooking", "domain_skill", ["cooking"]),
    # soft skills
    ("Problem Solving", "soft_skill", ["problem solving", "problem-solving"]),
    ("Time Management", "soft_skill", ["time management"]),
    ("Attention to Detail", "soft_skill", ["attention to detail"]),
    ("Interpersonal Skills", "soft_skill", ["interpersonal skill", "interpersonal skills"]),
    ("Critical Thinking", "soft_skill", ["critical thinking"]),
    ("Decision Making", "soft_skill", ["decision making", "decision-making"]),
    ("Presentation Skills", "soft_skill", ["presentation skill", "presentation skills"]),
    ("Organizational Skills", "soft_skill", ["organizational skill", "organizational skills", "organisation skills"]),
    ("Communication", "soft_skill", ["communication", "communication skills"]),
    ("Teamwork", "soft_skill", ["teamwork", "team work"]),
    ("Leadership", "soft_skill", ["leadership"]),
    ("Adaptability", "soft_skill", ["adaptability"]),
    ("Negotiation", "soft_skill", ["negotiation"]),
    ("Planning", "soft_skill", ["planning skills"]),
    # languages
    ("Arabic", "language_skill", ["arabic language", "fluent in arabic"]),
    ("English", "language_skill", ["english language", "fluent in english", "english proficiency"]),
    ("French", "language_skill", ["french language", "fluent in french"]),
]
