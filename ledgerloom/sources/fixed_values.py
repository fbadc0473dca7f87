"""Seed tables as text.

Fixed values: they must equal the published seeds for results to agree, so they
are stated here in their natural order. Any of them can be replaced by a file,
see ``ledgerloom.sources.seeds``.
"""

CATEGORY_TAXONOMY = """\
category_l2,category_l1,description
cheese,dairy,Cheeses of all kinds
yoghurt_fermented,dairy,Yoghurt and fermented dairy desserts
milk_cream,dairy,Milk and dairy drinks
dairy_desserts,dairy,Sweet dairy desserts (not yoghurt)
meat_general,meat_fish_protein,Meat and meat preparations of unspecified type
poultry,meat_fish_protein,Chicken and other poultry
pork,meat_fish_protein,Pork products
beef,meat_fish_protein,Beef products
sausages_cold_cuts,meat_fish_protein,Sausages and cold cuts
fish_seafood,meat_fish_protein,Fish and seafood
eggs,meat_fish_protein,Eggs
meat_alternatives,plant_protein,Plant-based meat substitutes
legumes_pulses,plant_protein,Beans lentils and other legume products
dairy_alternatives,plant_protein,Plant milks and dairy substitutes
nuts_seeds,plant_protein,Nuts and seeds
fresh_vegetables,vegetables,Fresh and prepared vegetables
canned_preserved_vegetables,vegetables,Canned or preserved vegetables
fresh_fruit,fruit,Fresh and prepared fruit
bread,grains_bread_pasta,Bread
pasta_noodles,grains_bread_pasta,Pasta and noodles
breakfast_cereals,grains_bread_pasta,Breakfast cereals and muesli
grains_potatoes_other,grains_bread_pasta,Grains and potatoes not further specified
salty_snacks,snacks_sweets,Chips crisps and savory snacks
sweet_snacks_confectionery,snacks_sweets,Biscuits cakes and candy
chocolate,snacks_sweets,Chocolate products
desserts_ice_cream,snacks_sweets,Non-dairy desserts and ice cream
sweet_spreads,snacks_sweets,Jam peanut butter and sweeteners
water,beverages,Water
soda_carbonated,beverages,Soda and carbonated drinks
juice,beverages,Juices and nectars
hot_beverages,beverages,Coffee and tea
alcoholic,beverages,Beer wine and spirits
beverages_other,beverages,Generic or unspecified beverages
savory_sauces,sauces_condiments,Sauces and condiments
savory_spreads,sauces_condiments,Savory spreads
cooking_aids_spices,sauces_condiments,Spices and cooking or baking helpers
vegetable_oils,fats_oils,Cooking and olive oils
margarine_spreadable_fats,fats_oils,Margarine and spreadable fats
meals_general,ready_meals,Prepared meals
soups,ready_meals,Soups
salads_prepared,ready_meals,Prepared salads
canned_general,ready_meals,Canned foods not further specified
frozen_foods,ready_meals,Frozen foods not further specified
beauty_personal_care,non_food,Cosmetics skincare and perfume
home_pet_auto,non_food,Home pet and car-care products
dietary_supplements,other,Dietary and bodybuilding supplements
baby_food,other,Baby food
other,other,True fallback for unmapped or uncategorised products
"""

CATEGORY_MAPPING = """\
off_category_tag,category_l2,priority
en:plant-based-foods-and-beverages,other,4
en:plant-based-foods,other,4
en:snacks,salty_snacks,4
en:sweet-snacks,sweet_snacks_confectionery,3
en:beverages,beverages_other,4
nl:beauty,beauty_personal_care,3
en:cereals-and-potatoes,grains_potatoes_other,3
en:beverages-and-beverages-preparations,beverages_other,4
en:dairies,milk_cream,4
en:condiments,savory_sauces,4
en:fruits-and-vegetables-based-foods,fresh_fruit,4
en:cereals-and-their-products,breakfast_cereals,3
en:fermented-foods,yoghurt_fermented,4
en:fermented-milk-products,yoghurt_fermented,3
nl:make-up,beauty_personal_care,2
en:meals,meals_general,3
en:meats-and-their-products,meat_general,3
en:spreads,savory_spreads,4
en:desserts,desserts_ice_cream,3
en:biscuits-and-cakes,sweet_snacks_confectionery,2
en:sauces,savory_sauces,3
en:confectioneries,sweet_snacks_confectionery,3
en:plant-based-beverages,beverages_other,3
nl:verzorging,beauty_personal_care,3
en:breads,bread,2
en:vegetables-based-foods,fresh_vegetables,3
en:breakfasts,breakfast_cereals,4
en:cheeses,cheese,3
en:cocoa-and-its-products,chocolate,3
en:dietary-supplements,dietary_supplements,2
en:meats,meat_general,3
en:biscuits,sweet_snacks_confectionery,2
en:salty-snacks,salty_snacks,2
nl:gezondheid,dietary_supplements,4
en:plant-based-spreads,margarine_spreadable_fats,2
nl:parfum,beauty_personal_care,2
nl:baby,baby_food,2
en:biscuits-and-crackers,sweet_snacks_confectionery,3
en:frozen-foods,frozen_foods,3
en:legumes-and-their-products,legumes_pulses,2
en:dairy-desserts,dairy_desserts,2
en:nuts-and-their-products,nuts_seeds,2
en:candies,sweet_snacks_confectionery,2
en:appetizers,salty_snacks,3
en:chocolates,chocolate,2
en:fruits-based-foods,fresh_fruit,3
en:canned-foods,canned_general,3
en:vegetable-based-foods-and-beverages,fresh_vegetables,4
en:prepared-meats,meat_general,2
en:breakfast-cereals,breakfast_cereals,2
en:vegetables,fresh_vegetables,3
en:seeds,nuts_seeds,3
en:fermented-dairy-desserts,yoghurt_fermented,2
en:fruit-based-beverages,juice,3
en:fats,margarine_spreadable_fats,4
en:hot-beverages,hot_beverages,3
en:alcoholic-beverages,alcoholic,3
en:pastas,pasta_noodles,2
en:dried-products,other,4
en:carbonated-drinks,soda_carbonated,2
en:sweet-spreads,sweet_spreads,2
en:chips-and-fries,salty_snacks,2
en:meat-alternatives,meat_alternatives,2
en:yogurts,yoghurt_fermented,2
nl:lipmake-up,beauty_personal_care,1
en:seafood,fish_seafood,3
en:bodybuilding-supplements,dietary_supplements,1
en:salted-spreads,savory_spreads,2
en:beverage-preparations,beverages_other,4
en:nuts,nuts_seeds,3
nl:damesparfum,beauty_personal_care,1
en:sodas,soda_carbonated,2
en:juices-and-nectars,juice,2
en:soups,soups,2
en:crisps,salty_snacks,2
en:fruits,fresh_fruit,3
en:chicken-and-its-products,poultry,2
en:canned-plant-based-foods,canned_preserved_vegetables,3
en:dairy-substitutes,dairy_alternatives,3
en:vegetable-fats,margarine_spreadable_fats,3
en:legumes,legumes_pulses,3
en:cow-cheeses,cheese,2
en:groceries,other,4
nl:skincare,beauty_personal_care,2
en:fishes-and-their-products,fish_seafood,2
en:bars,sweet_snacks_confectionery,3
en:frozen-desserts,desserts_ice_cream,2
en:poultries,poultry,2
en:fruit-juices,juice,2
en:fishes,fish_seafood,3
en:ice-creams-and-sorbets,desserts_ice_cream,2
en:chickens,poultry,2
en:coffees,hot_beverages,2
en:meat-preparations,meat_general,2
en:teas,hot_beverages,2
en:meat-analogues,meat_alternatives,2
en:chocolate-candies,chocolate,2
en:dried-products-to-be-rehydrated,other,4
en:cooking-helpers,cooking_aids_spices,3
en:cereal-grains,breakfast_cereals,2
en:uncooked-pressed-cheeses,cheese,2
en:prepared-salads,salads_prepared,2
en:gouda,cheese,1
en:artificially-sweetened-beverages,soda_carbonated,2
en:bread-coverings,savory_spreads,4
en:mueslis,breakfast_cereals,1
en:tomatoes-and-their-products,fresh_vegetables,2
en:spreadable-fats,margarine_spreadable_fats,2
en:milk-substitutes,dairy_alternatives,2
en:ice-creams,desserts_ice_cream,2
en:oilseed-purees,nuts_seeds,2
en:cakes,sweet_snacks_confectionery,2
en:fatty-fishes,fish_seafood,2
en:sausages,sausages_cold_cuts,2
en:canned-vegetables,canned_preserved_vegetables,2
nl:haarverzorging,beauty_personal_care,2
en:dairy-drinks,milk_cream,2
en:baby-foods,baby_food,2
en:vegetable-oils,vegetable_oils,2
en:plant-based-milk-alternatives,dairy_alternatives,1
en:kaas,cheese,3
en:sweeteners,sweet_spreads,3
en:milks,milk_cream,2
en:beers,alcoholic,2
en:waters,water,2
en:spices,cooking_aids_spices,2
en:legume-seeds,legumes_pulses,2
en:pork-and-its-products,pork,2
en:sweetened-beverages,soda_carbonated,3
en:culinary-plants,fresh_vegetables,3
en:dried-plant-based-foods,other,4
nl:wonen,home_pet_auto,3
en:dark-chocolates,chocolate,1
en:herbal-teas,hot_beverages,2
nl:foundation,beauty_personal_care,1
en:syrups,sweet_spreads,3
en:wines,alcoholic,2
en:crackers-appetizers,salty_snacks,2
en:pastry-helpers,cooking_aids_spices,3
en:pulses,legumes_pulses,3
en:fruit-and-vegetable-preserves,canned_preserved_vegetables,3
nl:mondverzorging,beauty_personal_care,2
en:beef-and-its-products,beef,2
en:noodles,pasta_noodles,2
en:tomato-sauces,savory_sauces,2
en:jams,sweet_spreads,2
en:legume-butters,legumes_pulses,2
en:peanut-butters,sweet_spreads,2
en:pork,pork,3
en:festive-foods,other,4
en:mayonnaises,savory_sauces,2
nl:nagels,beauty_personal_care,1
en:dips,savory_sauces,2
en:vegetable-soups,soups,1
en:protein-powders,dietary_supplements,1
en:pasta-dishes,pasta_noodles,2
en:olive-tree-products,vegetable_oils,3
en:farming-products,meat_general,4
en:tea-based-beverages,hot_beverages,2
en:sandwiches,meals_general,2
en:olive-oils,vegetable_oils,1
en:extra-virgin-olive-oils,vegetable_oils,1
en:virgin-olive-oils,vegetable_oils,1
en:salmons,fish_seafood,1
en:wild-salmons,fish_seafood,1
nl:dier,home_pet_auto,2
nl:honden,home_pet_auto,1
nl:auto-onderhoud,home_pet_auto,2
nl:autoreinigingsproducten,home_pet_auto,1
nl:huishouden,home_pet_auto,3
nl:buiten-en-vrije-tijd,home_pet_auto,4
nl:reisproducten-hond,home_pet_auto,1
"""

NUTRIENT_REFERENCE = """\
nutrient,display_name,standard_unit,nutrient_group,is_mass
energy,Energy,kJ,energy,false
energy-kcal,Energy (kcal),kcal,energy,false
energy-kj,Energy (kJ),kJ,energy,false
proteins,Protein,g,macronutrient,true
carbohydrates,Carbohydrates,g,macronutrient,true
sugars,Sugars,g,macronutrient,true
added-sugars,Added sugars,g,macronutrient,true
sucrose,Sucrose,g,macronutrient,true
glucose,Glucose,g,macronutrient,true
fructose,Fructose,g,macronutrient,true
lactose,Lactose,g,macronutrient,true
maltose,Maltose,g,macronutrient,true
galactose,Galactose,g,macronutrient,true
fat,Fat,g,macronutrient,true
saturated-fat,Saturated fat,g,macronutrient,true
monounsaturated-fat,Monounsaturated fat,g,macronutrient,true
polyunsaturated-fat,Polyunsaturated fat,g,macronutrient,true
unsaturated-fat,Unsaturated fat,g,macronutrient,true
trans-fat,Trans fat,g,macronutrient,true
omega-3-fat,Omega-3 fat,g,macronutrient,true
omega-6-fat,Omega-6 fat,g,macronutrient,true
palmitic-acid,Palmitic acid,g,macronutrient,true
stearic-acid,Stearic acid,g,macronutrient,true
myristic-acid,Myristic acid,g,macronutrient,true
lauric-acid,Lauric acid,g,macronutrient,true
caprylic-acid,Caprylic acid,g,macronutrient,true
caproic-acid,Caproic acid,g,macronutrient,true
capric-acid,Capric acid,g,macronutrient,true
butyric-acid,Butyric acid,g,macronutrient,true
eicosapentaenoic-acid,Eicosapentaenoic acid (EPA),g,macronutrient,true
docosahexaenoic-acid,Docosahexaenoic acid (DHA),g,macronutrient,true
alpha-linolenic-acid,Alpha-linolenic acid,g,macronutrient,true
linoleic-acid,Linoleic acid,g,macronutrient,true
oleic-acid,Oleic acid,g,macronutrient,true
arachidonic-acid,Arachidonic acid,g,macronutrient,true
fiber,Fiber,g,macronutrient,true
starch,Starch,g,macronutrient,true
polyols,Polyols,g,macronutrient,true
cholesterol,Cholesterol,g,other,true
water,Water,g,other,true
caffeine,Caffeine,g,other,true
cocoa,Cocoa,g,other,true
sodium,Sodium,g,mineral,true
salt,Salt,g,mineral,true
added-salt,Added salt,g,mineral,true
chloride,Chloride,g,mineral,true
calcium,Calcium,g,mineral,true
iron,Iron,g,mineral,true
magnesium,Magnesium,g,mineral,true
zinc,Zinc,g,mineral,true
phosphorus,Phosphorus,g,mineral,true
copper,Copper,g,mineral,true
manganese,Manganese,g,mineral,true
potassium,Potassium,g,mineral,true
selenium,Selenium,g,mineral,true
iodine,Iodine,g,mineral,true
vitamin-a,Vitamin A,g,vitamin,true
beta-carotene,Beta-carotene,g,vitamin,true
vitamin-b1,Vitamin B1 (thiamin),g,vitamin,true
vitamin-b2,Vitamin B2 (riboflavin),g,vitamin,true
vitamin-b6,Vitamin B6,g,vitamin,true
vitamin-b9,Vitamin B9 (folate),g,vitamin,true
vitamin-b12,Vitamin B12,g,vitamin,true
vitamin-pp,Vitamin PP (niacin/B3),g,vitamin,true
pantothenic-acid,Pantothenic acid (B5),g,vitamin,true
biotin,Biotin (B7),g,vitamin,true
vitamin-c,Vitamin C,g,vitamin,true
vitamin-d,Vitamin D,g,vitamin,true
vitamin-e,Vitamin E,g,vitamin,true
vitamin-k,Vitamin K,g,vitamin,true
phylloquinone,Vitamin K1 (phylloquinone),g,vitamin,true
choline,Choline,g,vitamin,true
"""
